import pytest

from telltale.operators import serving


@pytest.fixture
def keyed(spark):
    return spark.createDataFrame(
        [
            ("AB-C 1234-20180629134501", 5.0),
            ("AB-C 1234-20180629134501", 5.0),
            ("AB-C 1234-20180629134459", 9.0),
            ("AB-C 1234-20180629134430", 7.0),
            ("B-AA 4567-20180629134501", 1.0),
            ("B-AA 4567-20180629134502", 2.0),
            ("odd key without a time", 3.0),
        ],
        "name string, sugar double",
    )


def test_strict_keeps_every_key_and_measure(keyed):
    found = [tuple(r) for r in serving.dashboard_strict(keyed).collect()]
    assert found[0][1] is None and found[0][2] == 3.0
    assert sorted(found[1:]) == sorted(
        [
            ("AB-C 1234", "2018-06-29 13:40:00", 7.0),
            ("AB-C 1234", "2018-06-29 13:40:00", 9.0),
            ("B-AA 4567", "2018-06-29 13:45:00", 1.0),
            ("B-AA 4567", "2018-06-29 13:45:00", 2.0),
            ("AB-C 1234", "2018-06-29 13:45:00", 5.0),
        ]
    )
    assert [(r[1], r[0]) for r in found[3:]] == [
        ("2018-06-29 13:45:00", "B-AA 4567"),
        ("2018-06-29 13:45:00", "B-AA 4567"),
        ("2018-06-29 13:45:00", "AB-C 1234"),
    ]


def test_roll_up(keyed):
    found = [tuple(r) for r in serving.dashboard_max(keyed).collect()]
    assert found[1:] == [
        ("AB-C 1234", "2018-06-29 13:40:00", 9.0),
        ("B-AA 4567", "2018-06-29 13:45:00", 2.0),
        ("AB-C 1234", "2018-06-29 13:45:00", 5.0),
    ]


def test_roll_up_combines_before_the_shuffle(keyed, plan):
    shown = plan(serving.dashboard_max(keyed))
    assert "partial_max(sugar" in shown and "HashAggregate" in shown


def test_count_and_peek(readings):
    made = readings(
        ("b", "2018-06-29 00:00:02", "car", "speed", "1"),
        ("a", "2018-06-29 00:00:01", "car", "speed", "1"),
        ("a", "2018-06-29 00:00:02", "car", "speed", "1"),
    )
    assert serving.reading_count(made).first()["n"] == 3
    top = [(r["messageid"], r["messagedate"].second) for r in serving.peek(made, 2).collect()]
    assert top == [("a", 1), ("a", 2)]


def test_peek_is_a_top_k(readings, plan):
    made = readings(("b", "2018-06-29 00:00:02", "car", "speed", "1"))
    assert "TakeOrderedAndProject" in plan(serving.peek(made))
