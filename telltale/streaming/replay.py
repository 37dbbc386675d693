"""Messages in quarantine, and another try at them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telltale.operators.decode import decode
from telltale.sinks.commits import Entry, effective, place_of, read_parts, schema_in
from telltale.streaming.speed import SpeedLayer

Repair = Callable[[DataFrame], DataFrame]


def _held(spark: SparkSession, path: str) -> list[Entry]:
    place = place_of(spark, path)
    if place is None:
        return []
    return [r for r in effective(spark, place.log) if r.table == place.table]


def _rows(spark: SparkSession, path: str, held: list[Entry]) -> DataFrame:
    schema = schema_in(held, held[0].table)
    rows = read_parts(spark, path, schema, [(r.folder, None) for r in held])
    # The name of a batch is in the log; a folder has a shortened one.
    names = [(r.folder.removeprefix("batch="), r.batch) for r in held]
    named = spark.createDataFrame(names, "batch string, batch_name string")
    return rows.join(F.broadcast(named), "batch").drop("batch")


def quarantined(spark: SparkSession, path: str) -> DataFrame | None:
    """Messages that could not be read and still cannot, with batch, place and time of arrival.

    Those of a batch that was replayed are what the replay left. None if there was
    never a bad message.
    """
    place = place_of(spark, path)
    if place is None:
        return None
    rows = effective(spark, place.log)
    held = [r for r in rows if r.table == place.table]
    replayed = {r.of for r in rows if r.of is not None}
    left = [r for r in held if r.attempt not in replayed]
    if left:
        return _rows(spark, path, left)
    return _rows(spark, path, held).limit(0) if held else None


def replay(spark: SparkSession, layer: SpeedLayer, repair: Repair | None = None) -> list[str]:
    """Read the messages in quarantine again, and write those that are readable now.

    ``repair`` may change the ``value`` of messages; what the decoder has learnt since
    needs none. All bad messages of a batch are tried, also those of an earlier replay, and
    the outcome takes the place of that replay: so a second one adds nothing. A replay counts as
    long as the attempt at its batch does; a batch that is repeated comes without it.
    Returns the batches.
    """
    path = layer.quarantine_path
    if path is None:
        raise ValueError("replay needs a quarantine_path")
    done = []
    for entry in _held(spark, path):
        if entry.of is not None:
            continue
        rows = _rows(spark, path, [entry])
        kept = [c for c in ("place", "position") if c in rows.columns]
        messages = rows.select(F.col("raw").alias("value"), *kept)
        decoded = decode(repair(messages) if repair else messages).persist()
        try:
            again = replace(layer, on_bad="quarantine")
            again.write(decoded, f"{entry.batch}~replay", of=entry.attempt)
        finally:
            decoded.unpersist()
        done.append(entry.batch)
    return sorted(done)
