"""CSV files, topics and the console."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from telltale.operators.decode import encode


def write_quoted_csv(frame: DataFrame, path: str) -> None:
    """CSV with a header line and every field quoted; quotes inside are doubled."""
    (
        frame.write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_quoted_csv(
    spark: SparkSession, path: str, schema: StructType, multiline: bool = False
) -> DataFrame:
    """Read it back; an empty field is NULL, as CSV does not tell the two apart.

    Fields with line breaks need ``multiline``, which reads a file in one piece.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )


def kafka_sink_options(brokers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def publish(readings: DataFrame, brokers: str, topic: str) -> None:
    """Send readings as JSON values without a message key."""
    encode(readings).write.format("kafka").options(**kafka_sink_options(brokers, topic)).save()


def publish_stream(
    readings: DataFrame, brokers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    writer = encode(readings).writeStream.format("kafka")
    return (
        writer.options(**kafka_sink_options(brokers, topic))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def show_stream(frame: DataFrame, rows: int = 10, drain: bool = False) -> StreamingQuery:
    """Print the first rows of every micro-batch, for debugging."""
    writer = frame.writeStream.format("console").option("numRows", rows).option("truncate", False)
    return (writer.trigger(availableNow=True) if drain else writer).start()
