"""Composite row keys ``name-yyyyMMddHHmmss`` and column families."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telltale.fixed import SECONDS_FORMAT
from telltale.functions.times import stamp

_SUFFIX = 14


def row_key(name: Column, time: Column) -> Column:
    return F.concat_ws("-", name, stamp(time))


def key_name(key: Column) -> Column:
    """Name part of a row key. Names hold dashes, so the key is cut from the right."""
    return F.when(
        F.length(key) > _SUFFIX,
        F.substring(key, F.lit(1), F.length(key) - F.lit(_SUFFIX + 1)),
    )


def key_time(key: Column) -> Column:
    """Time part of a row key, on a 24-hour clock; NULL if it cannot be read."""
    return F.try_to_timestamp(F.substring(key, -_SUFFIX, _SUFFIX), F.lit(SECONDS_FORMAT))


def family(metrics: Column) -> Column:
    return F.when(metrics.contains("driver"), "driver").otherwise("car")
