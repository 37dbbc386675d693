"""Command line of the jobs: ``python -m telltale <job> ...`` or by spark-submit."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from telltale.operators.decode import decode, good
from telltale.operators.windows import spine_days, spine_for, window_fill
from telltale.session import build_session
from telltale.sinks.exports import show_stream
from telltale.sinks import tables
from telltale.sinks.cellstore import fold
from telltale.sinks.tables import FAN, merge_packs, pack_batches, prune_mart, read_packed, write_mart
from telltale.sources.readings import (
    FILES_PER_BATCH,
    history,
    kafka_messages,
    text_messages,
    text_stream,
)
from telltale.sources.rules import RuleSet, check_rules, csv_rules, reloaded
from telltale.streaming.replay import replay
from telltale.streaming.speed import SpeedLayer, run_once


def _kafka_arguments(job: argparse.ArgumentParser) -> None:
    job.add_argument("--brokers")
    job.add_argument("--topic")
    job.add_argument("--starting", default="latest", help="latest, earliest or offsets as JSON")
    job.add_argument("--min-partitions", type=int, help="splits a topic partition that is large")
    job.add_argument("--max-per-batch", type=int, help="messages, or files with --text")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="telltale")
    jobs = top.add_subparsers(dest="job", required=True)

    for name in ("speed", "once"):
        job = jobs.add_parser(name, help="messages to history, alerts and cells")
        job.add_argument("--rules", required=True, help="CSV of threshold rules")
        job.add_argument("--out", required=True, help="folder of the output tables")
        job.add_argument("--text", help="folder of text files with one message per line")
        job.add_argument("--rule-sql", help="file with a rule query over inbox and rules")
        job.add_argument("--copy", help="second folder for the readings")
        job.add_argument("--on-bad", choices=("fail", "quarantine"), default="fail")
        if name == "speed":
            _kafka_arguments(job)
            job.add_argument("--rules-every", type=float, default=60, help="seconds")
            job.add_argument("--checkpoint", required=True)
            job.add_argument("--interval", default="1 second")
            job.add_argument("--drain", action="store_true", help="handle what is there and end")
        else:
            job.add_argument("--run", help="name of the run; repeating it replaces its rows")

    job = jobs.add_parser("batch", help="fill the windows since the day before into the mart")
    job.add_argument("--history", required=True)
    job.add_argument("--mart", required=True)
    job.add_argument("--as-of", type=date.fromisoformat)

    job.add_argument("--archive", help="folder of the packs of the history")

    job = jobs.add_parser("archive", help="pack the small files of finished batches")
    job.add_argument("--out", required=True, help="folder of the output tables")
    job.add_argument("--archive", required=True, help="folder of the packs")
    job.add_argument("--upto", type=date.fromisoformat, help="last day, yesterday if not given")

    job.add_argument("--merge", type=int, default=FAN, help="packs of a tier that make one of the next")

    job = jobs.add_parser("vacuum", help="remove files that nothing reads any more")
    job.add_argument("--out", required=True, help="folder of the output tables")
    job.add_argument("--archive", required=True, help="folder of the packs")
    job.add_argument("--mart", help="mart whose superseded windows go too")
    job.add_argument("--grace-hours", type=float, default=48, help="longer than any job runs")

    job = jobs.add_parser("fold", help="put latest cells into the sorted runs of a store")
    job.add_argument("--out", required=True, help="folder of the output tables")
    job.add_argument("--store", required=True, help="folder of the runs")
    job.add_argument("--merge", type=int, default=FAN, help="runs of a level that make one of the next")

    job = jobs.add_parser("replay", help="read the messages in quarantine again")
    job.add_argument("--rules", required=True, help="CSV of threshold rules")
    job.add_argument("--out", required=True, help="folder of the output tables")

    job = jobs.add_parser("show", help="print readings as they come, for debugging")
    job.add_argument("--text")
    _kafka_arguments(job)
    job.add_argument("--rows", type=int, default=10)
    job.add_argument("--drain", action="store_true")
    return top


def _layer(spark: SparkSession, options: argparse.Namespace) -> SpeedLayer:
    def load() -> RuleSet:
        return check_rules(csv_rules(spark, options.rules))

    text = Path(options.rule_sql).read_text() if options.rule_sql else None
    return SpeedLayer(
        rules=reloaded(load, getattr(options, "rules_every", 0)),
        history_path=f"{options.out}/history",
        alerts_path=f"{options.out}/alerts",
        cells_path=f"{options.out}/cells",
        quarantine_path=f"{options.out}/quarantine",
        copy_path=options.copy,
        rule_text=text,
        rule_text_path=f"{options.out}/rule_alerts" if text else None,
        on_bad=options.on_bad,
    )


def kafka_settings(options: argparse.Namespace) -> dict:
    settings = {"starting": options.starting, "min_partitions": options.min_partitions}
    if options.max_per_batch:
        settings["max_per_batch"] = options.max_per_batch
    return settings


def _stream(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.text:
        return text_stream(spark, options.text, options.max_per_batch or FILES_PER_BATCH)
    return kafka_messages(spark, options.brokers, options.topic, **kafka_settings(options))


def speed(spark: SparkSession, options: argparse.Namespace) -> None:
    interval = None if options.drain else options.interval
    layer = _layer(spark, options)
    layer.start(_stream(spark, options), options.checkpoint, interval).awaitTermination()


def once(spark: SparkSession, options: argparse.Namespace) -> None:
    run_once(_layer(spark, options), text_messages(spark, options.text), options.run)


def batch(spark: SparkSession, options: argparse.Namespace) -> None:
    as_of = options.as_of or datetime.now(timezone.utc).date()
    days = spine_days(as_of)
    if options.archive:
        readings = read_packed(spark, options.history, options.archive, *days)
    else:
        readings = history(spark, options.history, *days)
    write_mart(window_fill(readings, spine_for(as_of)), options.mart, as_of)


def archive(spark: SparkSession, options: argparse.Namespace) -> None:
    upto = options.upto or datetime.now(timezone.utc).date() - timedelta(days=1)
    for table in ("history", "alerts", "cells"):
        pack_batches(spark, f"{options.out}/{table}", f"{options.archive}/{table}", upto)
        merge_packs(spark, f"{options.archive}/{table}", options.merge)


def vacuum(spark: SparkSession, options: argparse.Namespace) -> None:
    grace = 3600 * options.grace_hours
    # Puts stay where they are: the store of cells folds them from there.
    for table in ("history", "alerts"):
        tables.vacuum(spark, f"{options.out}/{table}", f"{options.archive}/{table}", grace)
    if options.mart:
        prune_mart(spark, options.mart)


def fold_cells(spark: SparkSession, options: argparse.Namespace) -> None:
    fold(spark, f"{options.out}/cells", options.store, options.merge)


def replay_quarantine(spark: SparkSession, options: argparse.Namespace) -> None:
    layer = SpeedLayer(
        rules=check_rules(csv_rules(spark, options.rules)),
        history_path=f"{options.out}/history",
        alerts_path=f"{options.out}/alerts",
        cells_path=f"{options.out}/cells",
        quarantine_path=f"{options.out}/quarantine",
        on_bad="quarantine",
    )
    replay(spark, layer)


def show(spark: SparkSession, options: argparse.Namespace) -> None:
    readings = good(decode(_stream(spark, options)))
    show_stream(readings, options.rows, options.drain).awaitTermination()


def main(argv: Sequence[str] | None = None) -> None:
    options = parser().parse_args(argv)
    spark = build_session(f"telltale-{options.job}")
    jobs = {
        "speed": speed,
        "once": once,
        "batch": batch,
        "archive": archive,
        "vacuum": vacuum,
        "fold": fold_cells,
        "replay": replay_quarantine,
        "show": show,
    }
    jobs[options.job](spark, options)


if __name__ == "__main__":
    main()
