"""How evenly tasks work when a third of the readings share a key, a metric and a window.

Prints one line per stage with a shuffle: median and longest task, rows and spill,
from Spark's event log. ``python tools/skew.py 20000000``
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from telltale.operators.alerts import alert_details  # noqa: E402
from telltale.operators.cells import latest_cells, to_cells  # noqa: E402
from telltale.operators.windows import spine_over, window_fill  # noqa: E402
from telltale.session import build_session  # noqa: E402
from telltale.sources.rules import RuleSet  # noqa: E402


def main(rows: int) -> None:
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    log = f"{scratch}/events"
    os.makedirs(log)
    settings = {
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{log}",
        "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.log.level": "ERROR",
        "spark.checkpoint.dir": scratch,
    }
    spark = build_session("telltale-skew", **settings)
    i = F.col("id")
    hot = i % 3 == 0
    second = F.when(hot, i % 300).otherwise(i % 2_000_000)
    readings = spark.range(0, rows, 1, 16).select(
        i.cast("string").alias("messageid"),
        F.timestamp_seconds(F.lit(1_700_000_000) + second).alias("messagedate"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("n"), i % 5000)).alias("name"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("m"), i % 997)).alias("metrics"),
        (i % 101).cast("string").alias("value"),
    )
    rules = spark.range(998).select(
        F.when(F.col("id") == 997, "hot").otherwise(F.concat(F.lit("m"), "id")).alias("metrics"),
        F.lit("50").alias("value"),
        F.lit("1").alias("ent"),
        F.lit("gt").alias("mod"),
    )
    work = {
        "large rules": lambda: alert_details(readings, RuleSet(rules, small=False)),
        "latest cells": lambda: latest_cells(to_cells(readings)),
        "window fill": lambda: window_fill(readings, spine_over(readings)),
    }
    for name, run in work.items():
        spark.sparkContext.setJobDescription(name)
        run().write.format("noop").mode("overwrite").save()
    spark.stop()

    tasks, label = defaultdict(list), {}
    with open(glob.glob(f"{log}/*")[0]) as file:
        for event in map(json.loads, file):
            if event["Event"] == "SparkListenerStageSubmitted":
                label[event["Stage Info"]["Stage ID"]] = event["Properties"].get("spark.job.description")
            elif event["Event"] == "SparkListenerTaskEnd":
                tasks[event["Stage ID"]].append(event["Task Metrics"])
    print("work | stage | tasks | median s | longest s | rows, most in a task | spilled MB")
    for stage, metrics in sorted(tasks.items()):
        seconds = [m["Executor Run Time"] / 1000 for m in metrics]
        read = [m["Shuffle Read Metrics"]["Total Records Read"] for m in metrics]
        spilled = sum(m["Disk Bytes Spilled"] for m in metrics) / 1e6
        if len(metrics) > 1:
            print(
                f"{label.get(stage)} | {stage} | {len(metrics)} | {statistics.median(seconds):.2f} |"
                f" {max(seconds):.2f} | {sum(read)}, {max(read)} | {spilled:.0f}"
            )


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000)
