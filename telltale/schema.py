"""Schemas of the tables the jobs read and write."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

MESSAGE_FIELDS = ("name", "messageid", "messagedate", "metrics", "value")
READING_FIELDS = ("messageid", "messagedate", "name", "metrics", "value")


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


MESSAGE = _strings(*MESSAGE_FIELDS)

READING = StructType(
    [
        StructField("messageid", StringType()),
        StructField("messagedate", TimestampType()),
        StructField("name", StringType()),
        StructField("metrics", StringType()),
        StructField("value", StringType()),
    ]
)

STORED_READING = StructType([*READING.fields, StructField("event_date", DateType())])

RULE = _strings("metrics", "value", "ent", "mod")

# Where a message was in the topics it came from; ordered as its members are.
POSITION = StructType(
    [
        StructField("sent", TimestampType()),
        StructField("topic", StringType()),
        StructField("part", IntegerType()),
        StructField("offset", LongType()),
    ]
)

CELL = StructType(
    [
        StructField("row_key", StringType()),
        StructField("family", StringType()),
        StructField("qualifier", StringType()),
        StructField("value", StringType()),
        StructField("version", TimestampType()),
        StructField("arrival", LongType()),
        StructField("place", LongType()),
        StructField("messageid", StringType()),
    ]
)

# A put as it is stored, with its position in the topics, NULL if that is not known.
PUT = StructType([*CELL.fields, StructField("position", POSITION)])

# The table the registered queries read.
EVENT = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)
