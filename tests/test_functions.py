from datetime import datetime

import pytest
from pyspark.sql import functions as F

from telltale.functions.keys import family, key_name, key_time, row_key
from telltale.functions.numbers import number, truncated_int
from telltale.functions.times import bucket_start, event_time, label


def _each(spark, function, values):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in frame.select(function(F.col("v"))).collect()]


def test_truncated_int(spark):
    cases = {
        "190.857": 190,
        "-0.9": 0,
        "-7.99": -7,
        "  12.5 ": 12,
        "+3": 3,
        "12.": 12,
        ".5": 0,
        "-.5": 0,
        "1e3": 1000,
        "2147483647.9": 2147483647,
        "-2147483648.9": -2147483648,
        "2147483648": None,
        "9999999999.5": None,
        "99999999999999999999": None,
        "0.99999999999999999999999999999999999": 0,
        "abc": None,
        "12.5x": None,
        "1.2.3": None,
        "12d": None,
        "NaN": None,
        "": None,
        None: None,
    }
    assert dict(zip(cases, _each(spark, truncated_int, cases))) == cases


def test_number(spark):
    assert _each(spark, number, [" 0.5", "4", "x", None]) == [0.5, 4.0, None, None]


def test_event_time_takes_two_formats(spark):
    cases = {
        "20180629170000": datetime(2018, 6, 29, 17, 0, 0),
        "20180629235959": datetime(2018, 6, 29, 23, 59, 59),
        "201806291700": datetime(2018, 6, 29, 17, 0),
        "201812060102": datetime(2018, 12, 6, 1, 2),
        "2018-06": None,
        "20181329170000": None,
        "2018062917000000": None,
        "": None,
        None: None,
    }
    assert dict(zip(cases, _each(spark, event_time, cases))) == cases


def test_bucket_start_floors_also_before_1970(spark):
    def bucket(text):
        return label(bucket_start(text.cast("timestamp"), 300))

    cases = {
        "2018-06-29 13:45:01": "2018-06-29 13:45:00",
        "2018-06-29 13:44:59.999999": "2018-06-29 13:40:00",
        "1969-12-31 23:59:59.5": "1969-12-31 23:55:00",
        None: None,
    }
    assert dict(zip(cases, _each(spark, bucket, cases))) == cases


def test_bucket_start_equals_window(spark):
    frame = spark.range(2000).select(
        F.timestamp_micros(F.col("id") * 7_919_000_017 - 5_000_000_000_000).alias("t")
    )
    differing = frame.select(
        bucket_start(F.col("t"), 300).alias("a"), F.window("t", "5 minutes")["start"].alias("b")
    ).where("a != b OR a IS NULL")
    assert differing.isEmpty()


@pytest.mark.parametrize("name", ["AB-C 1234", "x", ""])
def test_row_key_round_trip(spark, name):
    time = datetime(2018, 6, 29, 13, 45, 1)
    keyed = spark.createDataFrame([(name, time)], "n string, t timestamp").select(
        row_key(F.col("n"), F.col("t")).alias("k")
    )
    found = keyed.select("k", key_name(F.col("k")), key_time(F.col("k"))).first()
    assert tuple(found) == (f"{name}-20180629134501", name, time)


def test_key_time_is_on_a_24_hour_clock(spark):
    keys = ["a-20180629124500", "a-20180629134500", "a-20180629004500", "short", None]
    assert _each(spark, key_time, keys) == [
        datetime(2018, 6, 29, 12, 45),
        datetime(2018, 6, 29, 13, 45),
        datetime(2018, 6, 29, 0, 45),
        None,
        None,
    ]
    assert _each(spark, key_name, ["short", None]) == [None, None]


def test_family(spark):
    assert _each(spark, family, ["driver-blood-pressure", "tire-pressure"]) == ["driver", "car"]
