"""Messages and stored readings, batch and streaming."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from telltale.functions.keys import row_key
from telltale.schema import EVENT, POSITION, STORED_READING
from telltale.sinks.commits import committed

TEXT = StructType([StructField("value", StringType())])

# A micro-batch takes so much at most, so that a first start or a catch-up is
# many batches and not one of unknown size.
MESSAGES_PER_BATCH = 10_000_000
FILES_PER_BATCH = 1000


def kafka_options(
    brokers: str,
    topic: str,
    starting: str = "latest",
    max_per_batch: int = MESSAGES_PER_BATCH,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``min_partitions`` splits the offset range of a topic partition that holds
    much more than the others; ``max_per_batch`` bounds a catch-up batch.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(max_per_batch),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_messages(spark: SparkSession, brokers: str, topic: str, **options) -> DataFrame:
    """The messages of a topic as an unbounded frame of ``value, place, position``."""
    source = spark.readStream.format("kafka").options(**kafka_options(brokers, topic, **options))
    return message_values(source.load())


def message_values(records: DataFrame) -> DataFrame:
    """Keep the value of key-value records as text, and where they were.

    ``place`` is the offset, which orders messages of one partition. ``position`` orders
    those of all partitions: the broker's time, topic, partition and offset.
    """
    place = [F.col("offset").alias("place")] if "offset" in records.columns else []
    if {"timestamp", "topic", "partition", "offset"} <= set(records.columns):
        members = zip(POSITION.fields, ("timestamp", "topic", "partition", "offset"), strict=True)
        cast = [F.col(c).cast(f.dataType).alias(f.name) for f, c in members]
        place.append(F.struct(*cast).alias("position"))
    return records.select(F.col("value").cast("string").alias("value"), *place)


def text_messages(spark: SparkSession, path: str) -> DataFrame:
    """One message per line of text files."""
    return spark.read.schema(TEXT).text(path)


def text_stream(
    spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """The same as a stream; every file is read once."""
    return spark.readStream.schema(TEXT).option("maxFilesPerTrigger", files_per_batch).text(path)


def history(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Stored readings that count, restricted to whole event dates before files are listed."""
    return committed(spark, path, first, last).select(*STORED_READING.names)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENT).parquet(f"{sf_dir}/events.parquet")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as readings.

    ``messagedate`` keeps the zone-less type of the file, so that range filters
    on it reach the parquet scan.
    """
    return as_readings(events(spark, sf_dir))


def event_reading_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream. The pattern makes it work for one file and a folder."""
    reader = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", FILES_PER_BATCH)
    stream = reader.parquet(f"{sf_dir}/events.parque[t]")
    return as_readings(stream).withColumn("messagedate", F.col("messagedate").cast("timestamp"))


def as_readings(table: DataFrame) -> DataFrame:
    return table.select(
        F.col("event_id").cast("string").alias("messageid"),
        F.col("ts").alias("messagedate"),
        F.concat(F.lit("U-"), F.col("user_id").cast("string")).alias("name"),
        F.col("event_type").alias("metrics"),
        F.col("value").cast("string").alias("value"),
    )


def event_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a table of composite keys and one measure."""
    name = F.concat(F.lit("U-"), F.col("user_id").cast("string"))
    return events(spark, sf_dir).select(
        row_key(name, F.col("ts")).alias("name"), F.col("value").alias("sugar")
    )
