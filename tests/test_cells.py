import random
from datetime import datetime

from pyspark.sql import functions as F

from telltale.fixed import CAR_WIDE_COLUMNS
from telltale.functions.times import bucket_start
from telltale.operators.cells import latest_cells, to_cells, wide_cells
from telltale.schema import CELL

T = "2018-06-29 13:45:0"
KEY = "car-20180629134501"


def test_cell_of_a_reading(readings, rows):
    made = readings(
        ("m", T + "1", "car", "driver-blood-pressure", "190.8"),
        ("m", T + "1", "car", "tire-pressure", "3"),
    )
    assert rows(to_cells(made), "row_key", "family", "qualifier", "value") == [
        (KEY, "car", "tire-pressure", "3"),
        (KEY, "driver", "driver-blood-pressure", "190.8"),
    ]
    assert to_cells(made, metric="tire-pressure").count() == 1


def test_key_time_may_be_another(readings, rows):
    made = readings(("m", T + "1", "car", "speed", "3"))
    coarse = to_cells(made, stamp=bucket_start(F.col("messagedate"), 300))
    assert rows(coarse, "row_key") == [("car-20180629134500",)]
    now = to_cells(made, stamp=F.current_timestamp()).first()["row_key"]
    assert now.startswith("car-20") and now != KEY


def _cells(spark, *rows, arrival=0):
    return spark.createDataFrame(
        [(r, "car", q, v, datetime(2018, 1, 1, 0, 0, t), arrival, 0, m) for r, q, v, t, m in rows],
        CELL,
    )


def test_a_later_put_of_the_same_version_wins(spark, rows):
    """Whatever its id is as text; 10 comes after 9."""
    first = _cells(spark, ("r", "a", "first", 1, "9"))
    later = _cells(spark, ("r", "a", "second", 1, "10"), arrival=1)
    for both in (first.unionByName(later), later.unionByName(first)):
        assert rows(latest_cells(both)) == [("r", "car", "a", "second")]
        assert rows(wide_cells(both, [("a", "car", "a")])) == [("r", "second")]
    further = later.withColumn("place", F.lit(5).cast("long")).withColumn("value", F.lit("third"))
    assert rows(latest_cells(later.unionByName(further))) == [("r", "car", "a", "third")]


def test_last_write_wins(spark, rows):
    cells = _cells(
        spark, ("r1", "a", "1", 1, "x"), ("r1", "a", "2", 2, "x"), ("r1", "b", "9", 1, "x")
    )
    assert rows(latest_cells(cells)) == [("r1", "car", "a", "2"), ("r1", "car", "b", "9")]
    wide = wide_cells(cells, [("a", "car", "a"), ("b", "car", "b"), ("c", "car", "c")])
    assert rows(wide) == [("r1", "2", "9", None)]


def test_ties_do_not_depend_on_the_order_of_rows(spark, rows):
    made = [("r", "a", str(v), 1, m) for v in range(3) for m in "xy"]
    for seed in range(4):
        random.Random(seed).shuffle(made)
        assert rows(latest_cells(_cells(spark, *made))) == [("r", "car", "a", "2")]


def test_a_null_written_last_stays(spark, rows):
    cells = _cells(spark, ("r", "a", "1", 1, "x"), ("r", "a", None, 2, "x"))
    assert rows(latest_cells(cells)) == [("r", "car", "a", None)]


def test_wide_car_view(readings):
    made = readings(
        ("m", T + "1", "car", "driver-blood-pressure", "190.8"),
        ("m", T + "1", "car", "current-speed", "130"),
        ("m", T + "2", "car", "engine-heat", "99"),
    )
    wide = wide_cells(to_cells(made))
    assert wide.columns == ["id", *[c[0] for c in CAR_WIDE_COLUMNS]]
    found = [r.asDict() for r in wide.collect()]
    assert len(found) == 1  # a row without any mapped cell does not appear
    assert found[0]["id"] == KEY
    assert found[0]["blood_pressure"] == "190.8" and found[0]["current_speed"] == "130"
    assert found[0]["tire_pressure"] is None


def test_same_qualifier_in_another_family_is_another_cell(spark, rows):
    cells = _cells(spark, ("r", "driver-x", "1", 1, "x")).withColumn("family", F.lit("driver"))
    other = cells.withColumn("family", F.lit("car")).withColumn("value", F.lit("2"))
    both = cells.unionByName(other)
    assert latest_cells(both).count() == 2
    wide = wide_cells(both, [("d", "driver", "driver-x"), ("c", "car", "driver-x")])
    assert rows(wide) == [("r", "1", "2")]


def test_one_shuffle_combined_before(spark, plan):
    cells = _cells(spark, ("r", "a", "1", 1, "x"))
    for frame in (latest_cells(cells), wide_cells(cells, [("a", "car", "a")])):
        shown = plan(frame)
        assert shown.count("Exchange (") == 1
        assert "partial_max" in shown and "Window" not in shown
