"""Event times, time buckets and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telltale.fixed import LABEL_FORMAT, MINUTES_FORMAT, SECONDS_FORMAT


def event_time(text: Column) -> Column:
    """Timestamp of a 14-digit (seconds) or 12-digit (minutes) text, else NULL.

    The length decides the format, since a year pattern may otherwise swallow
    digits of the month.
    """
    digits = F.length(text)
    return F.when(
        digits == 14, F.try_to_timestamp(text, F.lit(SECONDS_FORMAT))
    ).when(digits == 12, F.try_to_timestamp(text, F.lit(MINUTES_FORMAT)))


def bucket_start(time: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket a time lies in; NULL stays NULL.

    ``window()`` gives the same start but drops rows without a time and may be
    used once per operator only.
    """
    epoch = F.unix_seconds(time.cast("timestamp"))
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds)))


def label(time: Column) -> Column:
    """Text form of a window start."""
    return F.date_format(time, LABEL_FORMAT)


def stamp(time: Column) -> Column:
    """The 14-digit text used on the wire and in row keys."""
    return F.date_format(time, SECONDS_FORMAT)
