"""JSON messages to readings and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from telltale.functions.times import event_time, stamp
from telltale.schema import MESSAGE, MESSAGE_FIELDS, READING_FIELDS

_CORRUPT = "_corrupt"
_WIRE = StructType([*MESSAGE.fields, StructField(_CORRUPT, StringType())])
_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
}


def decode(messages: DataFrame) -> DataFrame:
    """Decode a ``value STRING`` frame of JSON objects, bad ones included.

    Adds ``raw`` (the message) and ``problem`` (NULL for a good reading) to the
    five reading columns. Works on batch and streaming frames alike and keeps
    one output row per input row. A NULL ``value`` is a reading without a value.
    ``place`` and ``position``, where a message was in its source, are kept if there.

    The parsed object goes through ``inline``: a filter on ``problem`` cannot be
    pushed below it, which would parse the text again for every member tested.
    """
    place = [c for c in messages.columns if c in ("place", "position")]
    parsed = messages.select(
        *place,
        F.col("value").alias("raw"),
        F.inline(F.array(F.from_json("value", _WIRE, _OPTIONS))),
    )
    timed = parsed.withColumn("sent", F.col("messagedate")).withColumn(
        "messagedate", event_time(F.col("sent"))
    )
    blank = F.col("raw").isNull() | (F.trim("raw") == "")
    absent = F.lit(False)
    for member in ("messageid", "sent", "metrics", "name"):
        absent = absent | F.col(member).isNull()
    problem = (
        F.when(blank | F.col(_CORRUPT).isNotNull(), "not a JSON object")
        .when(absent, "member missing")
        .when(F.col("messagedate").isNull(), "time unreadable")
    )
    return timed.select(*READING_FIELDS, *place, "raw", problem.alias("problem"))


def good(decoded: DataFrame) -> DataFrame:
    return placed(decoded).select(*READING_FIELDS)


def placed(decoded: DataFrame) -> DataFrame:
    """Good readings with their place in the source, if that is known."""
    return decoded.where(F.col("problem").isNull()).drop("raw", "problem")


def bad(decoded: DataFrame) -> DataFrame:
    """Messages that are no readings, with the reason and their place in the source if known."""
    kept = [c for c in decoded.columns if c in ("place", "position")]
    return decoded.where(F.col("problem").isNotNull()).select("raw", "problem", *kept)


def encode(readings: DataFrame) -> DataFrame:
    """The wire form of readings: one ``value`` column of JSON text."""
    members = {f: F.col(f) for f in MESSAGE_FIELDS}
    members["messagedate"] = stamp(F.col("messagedate"))
    return readings.select(
        F.to_json(F.struct(*[c.alias(f) for f, c in members.items()])).alias("value")
    )
