"""Micro-batches that know which stream they belong to."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start_batches(
    writer: DataStreamWriter,
    handle: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    interval: str | None,
) -> StreamingQuery:
    """Hand every micro-batch to ``handle`` with a name of its own and its number.

    The name joins the query id, which lives as long as the checkpoint, and the
    number of the batch: a restarted stream repeats the name, a new stream does
    not. ``interval=None`` handles what is there and ends.
    """
    query_id: Future[str] = Future()

    def each(batch: DataFrame, number: int) -> None:
        handle(batch, f"{query_id.result()}-{number}", number)

    writer = writer.foreachBatch(each).option("checkpointLocation", checkpoint)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    query = writer.start()
    query_id.set_result(query.id)
    return query
