"""Queries behind the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telltale.fixed import WINDOW_SECONDS
from telltale.functions.keys import key_name, key_time
from telltale.functions.numbers import number
from telltale.functions.times import bucket_start, label


def keyed_measures(cells: DataFrame, metric: str) -> DataFrame:
    """The cells of one metric as a table of composite keys and numbers."""
    return cells.where(F.col("qualifier") == metric).select(
        F.col("row_key").alias("name"), number(F.col("value")).alias("sugar")
    )


def dashboard_strict(
    keyed: DataFrame, seconds: int = WINDOW_SECONDS, ordered: bool = True
) -> DataFrame:
    """Name, window and measure, grouped by the whole key and the measure itself.

    So the maximum is that of a single value: one row per distinct key and
    measure. ``dashboard_max`` is the roll-up. Readers want the order; a writer
    does without it and its shuffle.
    """
    grouped = keyed.groupBy("name", "sugar").agg(F.max("sugar").alias("top"))
    found = grouped.select(
        key_name(F.col("name")).alias("name"),
        label(bucket_start(key_time(F.col("name")), seconds)).alias("swdate"),
        F.col("top").alias("sugar"),
    )
    return _in_order(found) if ordered else found


def _in_order(found: DataFrame) -> DataFrame:
    return found.orderBy(F.col("swdate").asc(), F.col("name").desc())


def dashboard_max(
    keyed: DataFrame, seconds: int = WINDOW_SECONDS, ordered: bool = True
) -> DataFrame:
    """Maximum of every name in every window, combined before the shuffle."""
    peeled = keyed.select(
        key_name(F.col("name")).alias("name"),
        bucket_start(key_time(F.col("name")), seconds).alias("window_start"),
        "sugar",
    )
    found = (
        peeled.groupBy("name", "window_start")
        .agg(F.max("sugar").alias("sugar"))
        .select("name", label(F.col("window_start")).alias("swdate"), "sugar")
    )
    return _in_order(found) if ordered else found


def reading_count(readings: DataFrame) -> DataFrame:
    return readings.agg(F.count("*").alias("n"))


def peek(readings: DataFrame, rows: int = 10) -> DataFrame:
    """The first readings by time; a top-k, not a full sort."""
    return readings.orderBy("messagedate", "messageid", "metrics").limit(rows)


def mart_scan(mart: DataFrame) -> DataFrame:
    """Every window as the latest run that covers it has it.

    Runs overlap and a run covers its windows whole, empty ones included, so the
    latest one decides. The summary has one row per window and is made from two
    columns; the rows of the mart are not shuffled for it unless it is large.
    """
    latest = mart.groupBy("messagedate").agg(F.max("run_date").alias("run_date"))
    rows = mart.select("messagedate", "run_date", "metrics", "name", "value")
    return rows.join(latest, ["messagedate", "run_date"]).select(
        "messagedate", "metrics", "name", "value"
    )
