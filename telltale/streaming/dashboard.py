"""The dashboard roll-up on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telltale.fixed import WINDOW_SECONDS
from telltale.functions.times import bucket_start, label
from telltale.sinks.commits import committed
from telltale.sinks.tables import write_batch
from telltale.streaming.batches import start_batches


def window_max(measures: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Maximum per name and window of some (name, messagedate, sugar)."""
    window = bucket_start(F.col("messagedate"), seconds)
    return measures.groupBy("name", window.alias("window_start")).agg(
        F.max("sugar").alias("sugar")
    )


def start_window_max(
    measures: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = "1 minute",
) -> StreamingQuery:
    """Append the maxima of every micro-batch.

    A maximum of maxima is the maximum, so no state is kept between batches and a
    reading counts however late it comes. One without a time is in no window.
    """

    def write(batch: DataFrame, name: str, number: int) -> None:
        timed = batch.where(F.col("messagedate").isNotNull())
        write_batch(window_max(timed), path, name, "window_start")

    return start_batches(measures.writeStream, write, checkpoint, interval)


def read_window_max(spark: SparkSession, path: str) -> DataFrame:
    """Current maxima, merged from those of all batches."""
    return (
        committed(spark, path)
        .groupBy("name", "window_start")
        .agg(F.max("sugar").alias("sugar"))
        .select("name", label(F.col("window_start")).alias("swdate"), "sugar")
    )
