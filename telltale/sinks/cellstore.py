"""Latest cells in sorted runs, below the log of puts.

A run holds the last put of each cell of some batches, in buckets by the address of the
cell and sorted in each. Runs of a level are merged into one of the next, so a put is
rewritten once a level. The manifest of runs is that of packs: it names the days of
batches that a run holds, so what is in no run yet is read from the log of puts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telltale.operators.cells import ADDRESS, last_put, latest_cells
from telltale.schema import PUT
from telltale.sinks.commits import DAY, read_parts
from telltale.sinks.files import read_text, write_text
from telltale.sinks.tables import FAN, name_pack, packed_batches, unpacked

# Of a store that is new. Enough that a bucket of the largest run is sorted in one task.
BUCKETS = 64
_REST = tuple(f for f in PUT.names if f not in ADDRESS)


def buckets_of(spark: SparkSession, store: str, buckets: int = BUCKETS) -> int:
    """How many buckets the runs of a store have; settled when it is made."""
    said = read_text(spark, f"{store}/_buckets")
    if said is None:
        write_text(spark, f"{store}/_buckets", str(buckets))
        said = read_text(spark, f"{store}/_buckets")
    return int(said)


def _last(puts: DataFrame) -> DataFrame:
    """The last put of every cell, with what orders it among later ones.

    Combined before the shuffle, so a cell that is put very often is a row a task.
    """
    found = puts.groupBy(*ADDRESS).agg(F.max(last_put(puts.columns)).alias("last"))
    return found.select(*ADDRESS, *[F.col(f"last.{c}").alias(c) for c in _REST])


def _addressed(puts: DataFrame) -> DataFrame:
    """Puts that have a whole address; no other one can be looked up."""
    return puts.dropna("any", subset=list(ADDRESS)).select(*PUT.names)


@contextmanager
def _registered(spark: SparkSession, path: str, buckets: int):
    """A run under a name of the catalog, as only tables there are known to be in buckets."""
    name = f"run_{uuid.uuid4().hex}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PUT.fields)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(ADDRESS)}) "
        f"SORTED BY ({', '.join(ADDRESS)}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    try:
        yield name
    finally:
        # The files stay: the table is an external one.
        spark.sql(f"DROP TABLE {name}")


def _bucketed(spark: SparkSession, store: str, run: str) -> DataFrame:
    with _registered(spark, f"{store}/runs/{run}", buckets_of(spark, store)) as name:
        # Resolved here, so it outlives the name.
        return spark.table(name)


def _runs(spark: SparkSession, store: str, runs: Sequence[str]) -> DataFrame:
    """Runs as plain files. A union of tables in buckets was seen to be grouped without a shuffle."""
    if not runs:
        return spark.createDataFrame([], PUT)
    return spark.read.schema(PUT).parquet(*[f"{store}/runs/{run}" for run in runs])


def _write_run(puts: DataFrame, store: str, run: str) -> None:
    spark = puts.sparkSession
    buckets = buckets_of(spark, store)
    with _registered(spark, f"{store}/runs/{run}", buckets) as name:
        dealt = _last(puts).repartition(buckets, *ADDRESS).sortWithinPartitions(*ADDRESS)
        dealt.select(*PUT.names).write.insertInto(name)


def _levels(spark: SparkSession, store: str) -> list[tuple[int, str]]:
    held = packed_batches(spark, store).select("tier", "pack").distinct().collect()
    return sorted((r["tier"], r["pack"]) for r in held)


def _tail(spark: SparkSession, log: str, store: str) -> DataFrame:
    """Puts that no run holds."""
    return _addressed(read_parts(spark, log, PUT, unpacked(spark, log, store)))


def fold(spark: SparkSession, log: str, store: str, fan: int = FAN, buckets: int = BUCKETS) -> list[str]:
    """Put the batches that no run holds into a run, and merge levels that have ``fan`` runs.

    A run counts once the manifest names it, in place of those it was made from, so a
    broken attempt is not read. Returns the new runs.
    """
    buckets_of(spark, store, buckets)
    todo, made = unpacked(spark, log, store), []
    if todo:
        run = uuid.uuid4().hex
        _write_run(_addressed(read_parts(spark, log, PUT, todo)), store, run)
        name_pack(spark, store, run, 0, [(d, f.removeprefix("batch=")) for f, d in todo])
        made.append(run)
    while True:
        levels: dict[int, list[str]] = {}
        for level, run in _levels(spark, store):
            levels.setdefault(level, []).append(run)
        full = [(level, runs) for level, runs in levels.items() if len(runs) >= fan]
        if not full:
            return made
        level, runs = min(full)
        run = uuid.uuid4().hex
        _write_run(_runs(spark, store, runs), store, run)
        held = packed_batches(spark, store).where(F.col("pack").isin(runs)).select(DAY, "batch")
        name_pack(spark, store, run, level + 1, [tuple(r) for r in held.collect()], runs)
        made.append(run)


def latest_stored(spark: SparkSession, log: str, store: str) -> DataFrame:
    """Last write of every cell, from the runs and the puts that came after them.

    The largest run is joined bucket by bucket, as it lies: it is not shuffled. What is above it, a
    fraction of it, is put together first.
    """
    runs = [run for _, run in _levels(spark, store)]
    puts = _tail(spark, log, store)
    if not runs:
        return latest_cells(puts)
    base = _bucketed(spark, store, runs[-1])
    above = _last(puts.unionByName(_runs(spark, store, runs[:-1])))
    old = base.select(*ADDRESS, last_put(base.columns).alias("old"))
    new = above.select(*ADDRESS, last_put(above.columns).alias("new"))
    both = old.join(new, list(ADDRESS), "full_outer")
    return both.select(*ADDRESS, F.greatest("old", "new")["value"].alias("value"))


def lookup(
    spark: SparkSession,
    log: str,
    store: str,
    keys: Iterable[str] | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """The latest cells of some row keys, or of all that begin with a text.

    The condition goes to the files. Buckets are sorted by row key, so of each file only the
    pages that may hold one are read.
    """
    if (keys is None) == (prefix is None):
        raise ValueError("either keys or a prefix")
    row = F.col("row_key")
    wanted: Column = row.isin(list(keys)) if keys is not None else row.startswith(prefix)
    runs = [run for _, run in _levels(spark, store)]
    stored = _runs(spark, store, runs).where(wanted)
    return latest_cells(_tail(spark, log, store).where(wanted).unionByName(stored))
