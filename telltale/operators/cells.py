"""Readings as cells of a key and column-family table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telltale.fixed import CAR_WIDE_COLUMNS
from telltale.functions.keys import family, row_key
from telltale.schema import POSITION

WideColumn = tuple[str, str, str]


def to_cells(
    readings: DataFrame,
    stamp: Column | None = None,
    metric: str | None = None,
    version: Column | None = None,
    arrival: Column | None = None,
) -> DataFrame:
    """One cell per reading.

    ``stamp`` is the time in the row key. The event time is the default, so a
    repeated batch writes the same keys; pass ``current_timestamp()`` for the
    time of processing or a bucket start for coarser rows. ``metric`` keeps the
    cells of one metric only. ``version`` is the time a write counts as, the
    event time if not given; of writes of one version the one with the larger
    ``arrival`` counts, then the one further on in its source (``place``). Where
    readings have a ``position`` in topics it decides before the arrival.
    """
    if metric is not None:
        readings = readings.where(F.col("metrics") == metric)
    time = F.col("messagedate") if stamp is None else stamp
    return readings.select(
        row_key(F.col("name"), time).alias("row_key"),
        family(F.col("metrics")).alias("family"),
        F.col("metrics").alias("qualifier"),
        F.col("value").cast("string").alias("value"),
        (F.col("messagedate") if version is None else version).alias("version"),
        (F.lit(0) if arrival is None else arrival).cast("long").alias("arrival"),
        (F.col("place") if "place" in readings.columns else F.lit(0).cast("long")).alias("place"),
        "messageid",
        (F.col("position") if "position" in readings.columns else _no_position()).alias("position"),
    )


def _no_position() -> Column:
    return F.lit(None).cast(POSITION)


# What a cell is known by.
ADDRESS = ("row_key", "family", "qualifier")


def last_put(columns: Sequence[str]) -> Column:
    """What puts of a cell are ordered by; the largest is the last.

    Of one version the put with the larger position in its topics counts, the broker's time
    first, in whatever order the batches came; without positions that of the later
    batch, then the one further on in its source. The message id and the value settle what is left, so a
    repeated run agrees.
    """
    known = F.col("position") if "position" in columns else _no_position()
    return F.struct("version", known.alias("position"), "arrival", "place", "messageid", "value")


def _digest(*keys: str) -> Column:
    """Leading group key of an aggregate that Spark does by sorting.

    A maximum of text cannot be kept in a hash table, so Spark sorts by the
    group keys. Row keys share long beginnings; a number in front decides nearly
    every comparison.
    """
    return F.xxhash64(*keys).alias("digest")


def latest_cells(cells: DataFrame) -> DataFrame:
    """Last write of every (row, family, qualifier).

    An aggregate and not a ranking: it combines before the shuffle, so a cell
    written very often sends one row per task.
    """
    keys = list(ADDRESS)
    return (
        cells.groupBy(_digest(*keys), *keys)
        .agg(F.max(last_put(cells.columns)).alias("last"))
        .select(*keys, F.col("last.value").alias("value"))
    )


def wide_cells(
    cells: DataFrame, columns: Iterable[WideColumn] = CAR_WIDE_COLUMNS, key: str = "id"
) -> DataFrame:
    """One row per row key with a column for every mapped cell.

    Rows without any mapped cell do not appear. Column list given up front, one
    shuffle, combined before it.
    """
    columns = list(columns)
    is_mapped = F.lit(False)
    picks = []
    for name, fam, qualifier in columns:
        hit = (F.col("family") == fam) & (F.col("qualifier") == qualifier)
        is_mapped = is_mapped | hit
        picks.append(F.max(F.when(hit, last_put(cells.columns))).alias(name))
    wide = cells.where(is_mapped).groupBy(_digest("row_key"), "row_key").agg(*picks)
    return wide.select(
        F.col("row_key").alias(key), *[F.col(f"{name}.value").alias(name) for name, _, _ in columns]
    )


def column_mapping(names: Iterable[str], mapping: str) -> list[WideColumn]:
    """Wide columns from a text such as ``driver:pressure, car:speed``, in the order of ``names``.

    Spaces and line ends around the entries do not count. The entry ``:key`` stands for the row key and
    takes a name; without it the first name is that of the row key, and is left out.
    """
    names = list(names)
    entries = [e.strip() for e in mapping.split(",") if e.strip()]
    if ":key" in entries:
        del names[entries.index(":key")]
        entries.remove(":key")
    elif len(names) == len(entries) + 1:
        del names[0]
    if len(names) != len(entries):
        raise ValueError(f"{len(names)} names for {len(entries)} columns")
    found = []
    for name, entry in zip(names, entries, strict=True):
        fam, sign, qualifier = entry.partition(":")
        if not sign or not fam.strip() or not qualifier.strip():
            raise ValueError(f"{entry!r} is no family and qualifier")
        found.append((name, fam.strip(), qualifier.strip()))
    return found
