"""A complete grid of time windows, filled with the readings that fall into it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telltale.fixed import WINDOW_COUNT, WINDOW_SECONDS
from telltale.functions.times import bucket_start, label

BROADCAST_WINDOWS = 500_000


@dataclass(frozen=True)
class Spine:
    """``windows`` consecutive windows of ``seconds``, the first holding ``start``."""

    start: Column
    windows: int = WINDOW_COUNT
    seconds: int = WINDOW_SECONDS

    @property
    def first(self) -> Column:
        return bucket_start(self.start, self.seconds)

    @property
    def end(self) -> Column:
        return F.timestamp_seconds(
            F.unix_seconds(self.first) + F.lit(self.windows * self.seconds)
        )

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per window."""
        offset = F.col("id") * F.lit(self.seconds)
        return spark.range(self.windows).select(
            F.timestamp_seconds(F.unix_seconds(self.first) + offset).alias("window_start")
        )

    def clip(self, readings: DataFrame) -> DataFrame:
        """The readings inside the spine, with their window.

        Both bounds fold to literals of the column's own type, so the test runs
        in the scan. All other readings would match no window.
        """
        kind = readings.schema["messagedate"].dataType
        sent = F.col("messagedate")
        return readings.where(
            (sent >= self.first.cast(kind)) & (sent < self.end.cast(kind))
        ).withColumn("window_start", bucket_start(sent, self.seconds))


def spine_for(
    as_of: date | None = None, windows: int = WINDOW_COUNT, seconds: int = WINDOW_SECONDS
) -> Spine:
    """The spine of a batch run: it begins at midnight of the day before ``as_of``."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return Spine(F.date_sub(day, 1).cast("timestamp"), windows, seconds)


def spine_days(
    as_of: date, windows: int = WINDOW_COUNT, seconds: int = WINDOW_SECONDS
) -> tuple[date, date]:
    """First and last event date of the spine of a batch run, for partition pruning."""
    first = as_of - timedelta(days=1)
    length = timedelta(seconds=max(windows * seconds - 1, 0))
    return first, (datetime.combine(first, time()) + length).date()


def spine_over(readings: DataFrame, seconds: int = WINDOW_SECONDS) -> Spine:
    """The spine from the first to the last reading; without readings it is empty.

    Only the two ends come to the driver.
    """
    sent = F.unix_seconds(F.col("messagedate").cast("timestamp"))
    low, high = readings.agg(F.min(sent), F.max(sent)).first()
    if low is None:
        return Spine(F.timestamp_seconds(F.lit(0)), 0, seconds)
    windows = high // seconds - low // seconds + 1
    return Spine(F.timestamp_seconds(F.lit(low)), windows, seconds)


def _bounded(frame: DataFrame, spine: Spine) -> DataFrame:
    """Broadcast a frame of at most one row per window if the spine is short enough."""
    return F.broadcast(frame) if spine.windows <= BROADCAST_WINDOWS else frame


def window_fill(readings: DataFrame, spine: Spine) -> DataFrame:
    """Spine LEFT OUTER JOIN readings on the window.

    Gives one row per reading inside the spine and one row of NULLs per window
    without a reading. The spine is a gapless grid, so a reading has a partner if
    and only if it lies between the ends: the matched half is a filter and needs
    neither join nor shuffle, however many readings share a window. The empty
    windows are those not among the distinct windows seen, a set no larger than
    the spine that is aggregated before its small shuffle and reads the time
    column alone.
    """
    inside = spine.clip(readings)
    matched = inside.select("messageid", "metrics", "name", "value", "window_start")
    seen = inside.select("window_start").distinct()
    empty = spine.frame(readings.sparkSession).join(
        _bounded(seen, spine), "window_start", "left_anti"
    )
    return _labelled(matched.unionByName(empty, allowMissingColumns=True))


def window_fill_nonempty(readings: DataFrame, spine: Spine) -> DataFrame:
    """The same without empty windows; the optimizer drops their half of the plan."""
    return window_fill(readings, spine).where(F.col("messageid").isNotNull())


def window_coverage(readings: DataFrame, spine: Spine) -> DataFrame:
    """Number of readings of every window of the spine, 0 for an empty one."""
    counts = spine.clip(readings).groupBy("window_start").agg(F.count("*").alias("n"))
    covered = spine.frame(readings.sparkSession).join(
        _bounded(counts, spine), "window_start", "left"
    )
    return covered.select(
        label(F.col("window_start")).alias("datewindows"),
        F.coalesce("n", F.lit(0)).alias("readings"),
    )


def _labelled(filled: DataFrame) -> DataFrame:
    return filled.select(
        "messageid", "metrics", "name", "value", label(F.col("window_start")).alias("datewindows")
    )
