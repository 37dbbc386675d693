"""Threshold rules: literal rows, CSV files, delimited text and tables."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telltale.schema import RULE
from telltale.session import run_dir

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 * 1024 * 1024

Rule = tuple[str, str, str, str]


@dataclass(frozen=True)
class RuleSet:
    """Checked rules. ``small`` says that their measured size allows a broadcast.

    ``most`` is the largest number of rules of one metric, as far as it was measured.
    """

    frame: DataFrame
    small: bool
    most: int = 1


def values_clause(rows: Iterable[Sequence[str]]) -> tuple[str, dict[str, str]]:
    """``(:v0_0, :v0_1), ...`` and its arguments.

    Named, because positional arguments of a VALUES list of several rows were
    seen to be bound in another order.
    """
    rows = list(rows)
    args = {f"v{i}_{j}": field for i, row in enumerate(rows) for j, field in enumerate(row)}
    lines = ("(" + ", ".join(f":v{i}_{j}" for j in range(len(r))) + ")" for i, r in enumerate(rows))
    return ", ".join(lines), args


def literal_rules(spark: SparkSession, rows: Iterable[Rule]) -> DataFrame:
    """Rules as a VALUES relation, which Catalyst sees with its true size."""
    clause, args = values_clause(rows)
    return spark.sql(
        f"SELECT * FROM VALUES {clause} AS r(metrics, value, ent, mod)", args=args
    )


def csv_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from CSV with a header line and double-quoted fields."""
    return (
        spark.read.schema(RULE)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def delimited_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from comma-separated text without header or quotes.

    A backslash takes the next character as it is, a comma too, and ``\\N`` is
    NULL. The CSV reader knows escapes inside quotes only, so lines are cut here.
    """
    fields = F.regexp_extract_all("value", F.lit(r"((?:[^\\,]|\\.)*)(?:,|$)"), F.lit(1))

    def field(i: int) -> Column:
        raw = F.get(F.col("fields"), F.lit(i))
        return F.when(raw != r"\N", F.regexp_replace(raw, r"\\(.)", "$1"))

    lines = spark.read.text(path).select(fields.alias("fields"))
    return lines.select(*[field(i).alias(n) for i, n in enumerate(RULE.names)])


def check_rules(
    rules: DataFrame,
    unique: Sequence[str] = ("metrics", "mod"),
    broadcast_rows: int = BROADCAST_ROWS,
) -> RuleSet:
    """Settle rules, refuse those that are loaded twice, and measure the rest.

    What is checked is what is used from then on, whatever becomes of the file that the rules
    came from: a few rules are kept as rows, more than ``broadcast_rows`` or
    ``BROADCAST_BYTES`` as a copy in the shared folder. A duplicate would raise every
    alert of its metric twice. Rules with several thresholds for one metric and mode pass
    with ``unique`` widened by ``value``; then the rules of a metric are counted too.
    """
    spark = rules.sparkSession
    rules = rules.select(*RULE.names)
    rows = rules.take(broadcast_rows + 1)
    width = sum(len(v.encode()) for r in rows for v in r if v is not None)
    if len(rows) > broadcast_rows or width > BROADCAST_BYTES:
        return _check_many(rules, unique)
    for key, n in Counter(tuple(r[c] for c in unique) for r in rows).items():
        if n > 1:
            _refuse(dict(zip(unique, key, strict=True)))
    most = max(Counter(r["metrics"] for r in rows).values(), default=0)
    return RuleSet(spark.createDataFrame(rows, RULE), True, most if "value" in unique else 1)


def _refuse(rule: dict) -> None:
    raise ValueError(f"rule given more than once: {rule}")


def _check_many(rules: DataFrame, unique: Sequence[str]) -> RuleSet:
    path = run_dir(rules.sparkSession, "rules")
    rules.write.parquet(path)
    held = rules.sparkSession.read.schema(RULE).parquet(path)
    twice = held.groupBy(*unique).count().where("count > 1").take(1)
    if twice:
        _refuse({c: twice[0][c] for c in unique})
    if "value" not in unique:
        # One threshold for each mode at most.
        return RuleSet(held, False)
    most = held.groupBy("metrics").count().agg(F.max("count")).first()[0]
    return RuleSet(held, False, most or 0)


def reloaded(load: Callable[[], RuleSet], seconds: float = 60) -> Callable[[], RuleSet]:
    """Load rules when they are asked for, but not again for so many seconds."""
    held: list = []

    def current() -> RuleSet:
        now = time.monotonic()
        if not held or now - held[1] >= seconds:
            held[:] = [load(), now]
        return held[0]

    return current
