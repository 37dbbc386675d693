"""Parquet tables: appends, repeatable micro-batches, the mart and the archive of packs."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from telltale.sinks.commits import (
    Attempt,
    Part,
    Place,
    compact_log,
    effective,
    parts_in,
    place_of,
    read_parts,
    retire,
    schema_in,
    sweep,
    within,
)
from telltale.sinks.files import delete, exists, subfolders, write_text
from telltale.sources.rules import values_clause


def with_event_date(frame: DataFrame, time: str = "messagedate") -> DataFrame:
    """Add the partition column: one folder per day, not one per second."""
    return frame.withColumn("event_date", F.to_date(F.col(time)))


def create_table(spark: SparkSession, name: str, schema: StructType, path: str) -> None:
    """Drop the table if there is one and create it over parquet files at ``path``."""
    drop_table(spark, name)
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def append_table(frame: DataFrame, name: str, path: str | None = None) -> None:
    """Append to a catalog table; columns are matched by name."""
    writer = frame.write.mode("append").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def insert_rows(spark: SparkSession, name: str, rows: Iterable[Sequence[str]]) -> None:
    """INSERT literal rows."""
    clause, args = values_clause(rows)
    spark.sql(f"INSERT INTO {name} VALUES {clause}", args=args)


def append_by_date(frame: DataFrame, path: str) -> None:
    """Append readings to files by event date, as a batch of their own."""
    write_batch(frame, path, f"append-{uuid.uuid4().hex}", "messagedate")


def write_batch(frame: DataFrame, path: str, batch: str, time: str | None = None) -> None:
    """Write and commit a batch of one table; a repeat leaves exactly its own rows.

    ``batch`` has to name the run as well as the number of the batch, or a new
    stream over the same table would replace the batches of an old one. Rows are
    parted by the day of ``time``.
    Batches of several tables go through one ``Attempt``.
    """
    attempt = Attempt(frame.sparkSession, batch)
    add_to(attempt, frame, path, time)
    attempt.commit()


def add_to(attempt: Attempt, frame: DataFrame, path: str, time: str | None = None) -> None:
    """Write a table of a batch, by the day of ``time`` if there is one."""
    if time is not None:
        frame = with_event_date(frame, time)
    attempt.write(frame, path, partitioned=time is not None)


def write_mart(filled: DataFrame, path: str, as_of: date) -> None:
    """Store the filled windows of one batch run.

    A run owns the partitions of its date, so repeating it replaces its own rows
    and leaves those of other runs alone. Runs overlap in part; ``mart_scan``
    takes every window from the latest run that covers it. The mart names the window start twice, as its writer and as its reader call it.
    Last of all the run's first and last window go into an index, without which ``read_mart`` does not
    see the run.
    """
    mart = (
        filled.withColumn("messagedate", F.col("datewindows"))
        .withColumn("window_date", F.to_date(F.substring("datewindows", 1, 10)))
    )
    spark, index = filled.sparkSession, f"{path}/_coverage/run={as_of}"
    # A run that is repeated is not there until it is whole again.
    delete(spark, index)
    writer = _gathered(mart, "window_date").write.mode("overwrite")
    writer.partitionBy("window_date").parquet(f"{path}/run_date={as_of}")
    written = spark.read.schema("datewindows string").parquet(f"{path}/run_date={as_of}")
    first, last = written.agg(F.min("datewindows"), F.max("datewindows")).first()
    said = {"run_date": f"{as_of}", "first": first, "last": last}
    write_text(spark, f"{index}/entry.json", json.dumps(said))


class Won(NamedTuple):
    """Windows of one day that a run gives: from the first up to and without the last label."""

    run_date: date
    window_date: date
    first: str
    before: str


def _coverage(spark: SparkSession, path: str) -> list[tuple[date, str, str]]:
    index = f"{path}/_coverage"
    if not exists(spark, index):
        return []
    rows = spark.read.schema("run_date date, first string, last string").json(index)
    rows = rows.select("run_date", "first", "last").where("first IS NOT NULL")
    return [tuple(r) for r in rows.collect()]


def windows_won(covered: Iterable[tuple[date, str, str]]) -> list[Won]:
    """Which windows each run gives, if of those that cover a window the latest does.

    Runs are swept from the latest one back, and a run gives what none after it covers. It covers
    all windows from its first to its last.
    """
    won: list[Won] = []
    # Stretches that later runs cover, apart from each other and in order.
    taken: list[tuple[datetime, datetime]] = []
    for run, first, last in sorted(covered, reverse=True):
        at = datetime.fromisoformat(first)
        end = datetime.fromisoformat(last) + timedelta(seconds=1)
        taken.append((at, end))
        for low, high in [*sorted(taken[:-1]), (end, end)]:
            won += _by_day(run, at, min(low, end))
            at = max(at, high)
        taken = _joined(sorted(taken))
    return sorted(won)


def _joined(stretches: list[tuple[datetime, datetime]]) -> list[tuple[datetime, datetime]]:
    out: list[tuple[datetime, datetime]] = []
    for low, high in stretches:
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _by_day(run: date, at: datetime, end: datetime) -> list[Won]:
    found = []
    while at < end:
        midnight = datetime.combine(at.date() + timedelta(days=1), datetime.min.time())
        found.append(Won(run, at.date(), f"{at}", f"{min(end, midnight)}"))
        at = midnight
    return found


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """Every window as the latest run that covers it has it.

    The index says which days of which runs give any window, and only those are listed
    and read. On the days on which one run takes over from another each gives its part.
    """
    won = windows_won(_coverage(spark, path))
    columns = ("messagedate", "metrics", "name", "value")
    if not won:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    here: dict[date, dict[str, float]] = {}
    paths = []
    for w in dict.fromkeys((w.run_date, w.window_date) for w in won):
        if w[0] not in here:
            here[w[0]] = subfolders(spark, f"{path}/run_date={w[0]}")
        if f"window_date={w[1]}" in here[w[0]]:
            paths.append(f"{path}/run_date={w[0]}/window_date={w[1]}")
    schema = ", ".join(f"{c} string" for c in columns) + ", run_date date, window_date date"
    rows = spark.read.schema(schema).option("basePath", path).parquet(*paths)
    # A few rows for each day that is read.
    given = spark.createDataFrame(won, "run_date date, window_date date, first string, before string")
    found = rows.join(F.broadcast(given), ["run_date", "window_date"])
    return found.where("messagedate >= first AND messagedate < before").select(*columns)


def prune_mart(spark: SparkSession, path: str) -> int:
    """Remove the days of runs that give no window any more; returns how many."""
    won = {(w.run_date, w.window_date) for w in windows_won(_coverage(spark, path))}
    gone = 0
    for run, _, _ in _coverage(spark, path):
        for name in subfolders(spark, f"{path}/run_date={run}"):
            day = date.fromisoformat(name.removeprefix("window_date="))
            if (run, day) not in won:
                delete(spark, f"{path}/run_date={run}/{name}")
                gone += 1
    return gone


# One row for each day of each batch that a pack holds. ``replaces`` names the
# packs that this one was made from.
_MANIFEST = "event_date date, batch string, pack string, tier int, replaces array<string>"
# So many packs of a tier are merged into one of the next.
FAN = 8


def packed_batches(spark: SparkSession, archive: str) -> DataFrame:
    """``(event_date, batch, pack, tier)`` of what the packs that count hold."""
    rows = _manifest(spark, archive)
    gone = rows.select(F.explode("replaces").alias("pack")).distinct()
    return rows.drop("replaces").join(gone, "pack", "left_anti").select(
        "event_date", "batch", "pack", "tier"
    )


def _manifest(spark: SparkSession, archive: str) -> DataFrame:
    path = f"{archive}/manifest"
    if not exists(spark, path):
        return spark.createDataFrame([], _MANIFEST)
    # The column that parts the entries is only a name of their folders.
    return spark.read.schema(_MANIFEST).parquet(path).select("event_date", "batch", "pack", "tier", "replaces")


def unpacked(spark: SparkSession, live: str, archive: str, *days: date | None) -> list[Part]:
    """Folders and days of the live table that no pack holds."""
    place = _logged(spark, live)
    here = parts_in(effective(spark, place.log), place.table, *days)
    if not here or not exists(spark, f"{archive}/manifest"):
        return here
    rows = [(d, f.removeprefix("batch="), f) for f, d in here]
    listed = spark.createDataFrame(rows, "event_date date, batch string, folder string")
    left = listed.join(packed_batches(spark, archive), ["event_date", "batch"], "left_anti")
    return [(r["folder"], r["event_date"]) for r in left.collect()]


def _logged(spark: SparkSession, live: str) -> Place:
    place = place_of(spark, live)
    if place is None:
        raise ValueError(f"{live}: not written in batches, so there is nothing to pack")
    return place


def _live_schema(spark: SparkSession, live: str) -> StructType:
    place = _logged(spark, live)
    return schema_in(effective(spark, place.log), place.table)


def pack_batches(
    spark: SparkSession, live: str, archive: str, last: date | None = None
) -> str | None:
    """Rewrite the many small files of finished batches into few large ones.

    Takes the batches of days up to ``last`` that no pack holds yet, late ones of
    old days included, and returns the name of the pack. The list of batches is
    fixed first, and a pack counts only once the manifest names it, so a broken
    run leaves nothing that is read, and rows that arrive meanwhile stay live.
    The live files stay until ``vacuum``.
    """
    todo = unpacked(spark, live, archive, None, last)
    if not todo:
        return None
    schema = _live_schema(spark, live)
    pack = uuid.uuid4().hex
    _write_pack(read_parts(spark, live, schema, todo), archive, pack)
    name_pack(spark, archive, pack, 0, [(d, f.removeprefix("batch=")) for f, d in todo])
    return pack


def _write_pack(rows: DataFrame, archive: str, pack: str) -> None:
    gathered = _gathered(rows, "event_date")
    gathered.write.partitionBy("event_date").parquet(f"{archive}/packs/pack={pack}")


def name_pack(
    spark: SparkSession,
    archive: str,
    pack: str,
    tier: int,
    held: Sequence[tuple[date, str]],
    replaces: Sequence[str] = (),
) -> None:
    """One file in the manifest, so a pack counts as a whole or not at all."""
    rows = [(day, batch, pack, tier, list(replaces)) for day, batch in held]
    entry = spark.createDataFrame(rows, _MANIFEST).coalesce(1)
    entry.write.parquet(f"{archive}/manifest/entry={pack}")


def merge_packs(spark: SparkSession, archive: str, fan: int = FAN) -> list[str]:
    """Rewrite packs into larger ones, tier by tier; returns the new packs.

    Each row is rewritten once a tier, and a day lies in fewer than ``fan`` packs
    of every tier, however often packs are made. A pack takes the place of
    those it was made from with one file in the manifest.
    """
    made = []
    while True:
        held = packed_batches(spark, archive)
        packs = held.groupBy("tier").agg(F.collect_set("pack").alias("packs"))
        full = [r for r in packs.collect() if len(r["packs"]) >= fan]
        if not full:
            return made
        tier, names = min((r["tier"], sorted(r["packs"])) for r in full)
        pack = uuid.uuid4().hex
        mine = held.where(F.col("pack").isin(names))
        days = mine.select("pack", "event_date").distinct().collect()
        rows = _read_packs(spark, archive, [(r["pack"], r["event_date"]) for r in days])
        _write_pack(rows.drop("pack"), archive, pack)
        held = [tuple(r) for r in mine.select("event_date", "batch").collect()]
        name_pack(spark, archive, pack, tier + 1, held, names)
        made.append(pack)


def _read_packs(spark: SparkSession, archive: str, taken: list[tuple[str, date]]) -> DataFrame:
    where = f"{archive}/packs"
    # One folder of each pack says what columns it has.
    some = {p: f"{where}/pack={p}/event_date={d}" for p, d in taken}
    schema = spark.read.option("mergeSchema", True).parquet(*some.values()).schema
    schema = StructType([*schema.fields, StructField("event_date", DateType())])
    return read_parts(spark, where, schema, [(f"pack={p}", d) for p, d in taken], key="pack")


def vacuum(spark: SparkSession, live: str, archive: str, grace: float) -> dict[str, int]:
    """Remove what nothing reads any more and was packed or replaced over ``grace`` seconds ago.

    That is live days that a pack holds, folders of attempts that do not count, packs
    that were merged or never named, and entries of the log that were rewritten. The log says
    first that live days are gone, then they go; from then on the archive alone has
    them. A reader that began before may still open files, so the grace time has to be
    longer than any job. Returns how many of each were removed.
    """
    place = _logged(spark, live)
    old = time.time() - grace
    named = subfolders(spark, f"{archive}/manifest")
    settled = {n.removeprefix("entry=") for n, changed in named.items() if changed <= old}
    held = packed_batches(spark, archive)
    here = parts_in(effective(spark, place.log), place.table)
    rows = [(d, f.removeprefix("batch="), f) for f, d in here]
    listed = spark.createDataFrame(rows, "event_date date, batch string, folder string")
    known = _manifest(spark, archive).where(F.col("pack").isin(sorted(settled)))
    found = listed.join(known, ["event_date", "batch"], "left_semi").collect()
    gone = [(r["folder"], r["event_date"]) for r in found]
    retire(spark, live, gone)
    for folder, day in gone:
        delete(spark, f"{live}/{folder}/event_date={day}")
    swept = sweep(spark, live, grace)
    counting = {r["pack"] for r in held.select("pack").distinct().collect()}
    packs = subfolders(spark, f"{archive}/packs")
    unread = [n for n, changed in packs.items() if changed <= old and n.removeprefix("pack=") not in counting]
    for name in unread:
        delete(spark, f"{archive}/packs/{name}")
    # Lower tiers first: the entry that replaced a pack outlives the entry of that pack.
    tiers = _manifest(spark, archive).select("pack", "tier").distinct().orderBy("tier").collect()
    for r in tiers:
        if r["pack"] in settled and r["pack"] not in counting:
            delete(spark, f"{archive}/manifest/entry={r['pack']}")
    entries = compact_log(spark, place.log, grace)
    return {"days": len(gone), "folders": len(swept), "packs": len(unread), "entries": entries}


def read_packed(
    spark: SparkSession,
    live: str,
    archive: str,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Packs, and every live batch that no pack holds.

    So a row is read once, whenever it arrived and whether its day was packed or
    not. Which folders that are is settled before the plan is made: live days that
    a pack holds are neither listed nor scanned, and the bounds leave out other
    days of both.
    """
    schema = _live_schema(spark, live)
    found = read_parts(spark, live, schema, unpacked(spark, live, archive, first, last))
    held = within(packed_batches(spark, archive), first, last)
    days = held.select("pack", "event_date").distinct().collect()
    if days:
        packs = _read_packs(spark, archive, [(r["pack"], r["event_date"]) for r in days])
        found = found.unionByName(packs.select(*found.columns))
    return found


def _gathered(frame: DataFrame, *day: str) -> DataFrame:
    """Deal rows out so that files get a good size.

    Rebalancing merges what is small and splits what is much larger than the
    rest, at run time.
    """
    return frame.hint("rebalance", *day)
