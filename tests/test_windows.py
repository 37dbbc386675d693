import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from telltale.operators import windows
from telltale.operators.windows import (
    Spine,
    spine_days,
    spine_for,
    spine_over,
    window_coverage,
    window_fill,
    window_fill_nonempty,
)

AS_OF = date(2018, 6, 30)


def test_spine_has_a_thousand_windows_from_yesterday(spark, rows):
    found = [r[0] for r in rows(spine_for(AS_OF).frame(spark))]
    assert len(found) == len(set(found)) == 1000
    assert found[0] == datetime(2018, 6, 29)
    assert found[-1] == datetime(2018, 7, 2, 11, 15)
    assert {b - a for a, b in zip(found, found[1:])} == {timedelta(minutes=5)}
    assert spine_days(AS_OF) == (date(2018, 6, 29), date(2018, 7, 2))


def test_spine_equals_the_digit_tables(spark, rows):
    """Three digits of 0 to 9 give the same offsets as the range does."""
    digits = range(10)
    offsets = [(a + 10 * b + 100 * c) * 300 for a in digits for b in digits for c in digits]
    start = datetime(2018, 6, 29)
    expected = sorted((start + timedelta(seconds=s),) for s in offsets)
    assert rows(spine_for(AS_OF).frame(spark)) == expected


def test_spine_is_anchored_at_today_by_default(spark):
    first, today = (
        spine_for().frame(spark).select(F.min("window_start"), F.first(F.current_date())).first()
    )
    assert first.date() in (today - timedelta(days=1), today - timedelta(days=2))


def test_spine_begins_with_the_bucket_of_an_uneven_start(spark, rows):
    uneven = Spine(F.lit("2018-06-29 00:03:52").cast("timestamp"), windows=2)
    assert rows(uneven.frame(spark)) == [
        (datetime(2018, 6, 29),),
        (datetime(2018, 6, 29, 0, 5),),
    ]


def test_one_reading_and_the_gaps(readings, rows):
    made = readings(
        ("m", "2018-06-29 00:03:52", "car", "speed", "1"),
        ("early", "2018-06-28 23:59:59.999", "car", "speed", "1"),
        ("late", "2018-07-02 11:20:00", "car", "speed", "1"),
        ("timeless", None, "car", "speed", "1"),
    )
    found = rows(window_fill(made, spine_for(AS_OF)))
    assert len(found) == 1000
    filled = [r for r in found if r[0] is not None]
    assert filled == [("m", "speed", "car", "1", "2018-06-29 00:00:00")]
    assert len({r[4] for r in found}) == 1000
    assert rows(window_fill_nonempty(made, spine_for(AS_OF))) == filled


@pytest.mark.parametrize("bound", [0, windows.BROADCAST_WINDOWS])
def test_fill_equals_the_outer_join(spark, readings, rows, monkeypatch, bound):
    """A third of the readings shares one window; both ways of joining agree."""
    monkeypatch.setattr(windows, "BROADCAST_WINDOWS", bound)
    draw = random.Random(3)
    made = []
    for i in range(300):
        offset = 1234 if i % 3 == 0 else draw.randrange(-90_000, 400_000)
        sent = datetime(2018, 6, 29) + timedelta(seconds=offset)
        made.append((str(i), str(sent), "car", "speed", str(i)))
    made = readings(*made)
    spine = spine_for(AS_OF)
    bucketed = made.withColumn("w", F.window("messagedate", "5 minutes")["start"])
    grid = spine.frame(spark)
    joined = grid.join(bucketed, F.col("window_start") == F.col("w"), "left")
    expected = joined.select(
        "messageid",
        "metrics",
        "name",
        "value",
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("datewindows"),
    )
    assert rows(window_fill(made, spine)) == rows(expected)
    counts = expected.groupBy("datewindows").agg(F.count("messageid"))
    assert rows(window_coverage(made, spine)) == rows(counts)


def test_spine_over_all_readings(readings, rows):
    made = readings(
        ("a", "2018-06-29 00:03:52", "car", "speed", "1"),
        ("b", "2018-06-29 00:21:00", "car", "speed", "1"),
    )
    spine = spine_over(made)
    assert spine.windows == 5
    assert len(rows(window_fill(made, spine))) == 5
    nothing = made.limit(0)
    assert rows(window_fill(nothing, spine_over(nothing))) == []


def test_time_range_reaches_the_scan(spark, readings, plan, tmp_path):
    path = str(tmp_path / "r")
    readings(("m", "2018-06-29 00:03:52", "car", "speed", "1")).write.parquet(path)
    stored = spark.read.parquet(path)
    shown = plan(window_fill(stored, spine_for(AS_OF)))
    pushed = [line for line in shown.splitlines() if line.startswith("PushedFilters")]
    assert len(pushed) == 2
    for bound in ("GreaterThanOrEqual(messagedate", "LessThan(messagedate"):
        assert all(bound in p for p in pushed)
    assert "ReadSchema: struct<messagedate:timestamp>" in shown  # the half that finds empty windows
    assert "SortMergeJoin" not in shown and "Cartesian" not in shown


def test_zoneless_times_are_pushed_too(spark, plan, tmp_path):
    path = str(tmp_path / "r")
    spark.sql(
        "SELECT '1' messageid, TIMESTAMP_NTZ'2018-06-29 00:03:52' messagedate, "
        "'car' name, 'speed' metrics, '1' value"
    ).write.parquet(path)
    shown = plan(window_fill(spark.read.parquet(path), spine_for(AS_OF)))
    assert "GreaterThanOrEqual(messagedate" in shown


def test_only_filled_windows_read_the_table_once(spark, readings, plan, tmp_path):
    path = str(tmp_path / "r")
    readings(("m", "2018-06-29 00:03:52", "car", "speed", "1")).write.parquet(path)
    shown = plan(window_fill_nonempty(spark.read.parquet(path), spine_for(AS_OF)))
    assert "Join" not in shown and "Exchange" not in shown and "Union" not in shown
