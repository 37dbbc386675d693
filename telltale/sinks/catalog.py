"""Tables of the catalog over what counts of a logged table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from telltale.sinks.commits import DAY, Part, effective, parts_in, place_of, schema_in

_KEYS = ("batch", DAY)


def _part(spec: str) -> tuple[str, str]:
    """The values of a partition as SHOW PARTITIONS writes it."""
    return tuple(piece.partition("=")[2] for piece in spec.split("/"))


def register(spark: SparkSession, name: str, path: str) -> None:
    """Create a partitioned table of the catalog over a logged one, and bring it up to date."""
    place = place_of(spark, path)
    schema = None if place is None else schema_in(effective(spark, place.log), place.table)
    if schema is None:
        raise ValueError(f"{path}: no batch of this table was committed")
    own = [f for f in schema.fields if f.name not in _KEYS]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own)
    at = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}, batch STRING, {DAY} DATE) USING parquet "
        f"PARTITIONED BY (batch, {DAY}) LOCATION '{at}'"
    )
    refresh(spark, name, path)


def refresh(spark: SparkSession, name: str, path: str) -> tuple[int, int]:
    """Add the partitions of new batches, with their statistics, and drop those that no longer count.

    Returns how many were added and dropped. Files stay as they are: the table is an
    external one.
    """
    place = place_of(spark, path)
    found: list[Part] = parts_in(effective(spark, place.log), place.table)
    wanted = {(folder.removeprefix("batch="), str(day)): folder for folder, day in found}
    here = {_part(r["partition"]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new, old = sorted(wanted.keys() - here), sorted(here - wanted.keys())
    if old:
        gone = ", ".join(f"PARTITION ({_spec(p)})" for p in old)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")
    if new:
        at = path.replace("'", "\\'")
        added = " ".join(
            f"PARTITION ({_spec(p)}) LOCATION '{at}/{wanted[p]}/{DAY}={p[1]}'" for p in new
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    for part in new:
        spark.sql(f"ANALYZE TABLE {name} PARTITION ({_spec(part)}) COMPUTE STATISTICS NOSCAN")
    return len(new), len(old)


def _spec(part: tuple[str, str]) -> str:
    return f"batch = '{part[0]}', {DAY} = DATE '{part[1]}'"
