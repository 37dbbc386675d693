"""Readings against threshold rules."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telltale.functions.numbers import truncated_int
from telltale.operators.guard import check_plan, check_text
from telltale.operators.thresholds import BLOCK, broken_rules, threshold_blocks
from telltale.sources.rules import RuleSet

SALTS = 64
# A metric with more rules is searched and not joined rule by rule.
CROWDED = 32


def fires(observed: Column, limit: Column, mod: Column) -> Column:
    """Whether a rule's mode lets the whole-number comparison raise an alert."""
    return (
        (mod.contains("gt") & (observed > limit))
        | (mod.contains("lt") & (observed < limit))
        | ((mod == "eq") & (observed == limit))
    )


def match_rules(readings: DataFrame, rules: RuleSet, salts: int = SALTS) -> DataFrame:
    """Every reading with every rule it breaks.

    An inner join: the rules' comparison rejects readings without a rule, and
    the optimizer does not see that through an outer join. Both whole numbers
    are computed below the join, once per reading and once per rule.

    Rules of a measured small size are broadcast, so readings are not shuffled
    and the join works on streaming readings too. Larger ones take a sort-merge
    join, whatever the optimizer takes their size to be. A metric with more than
    one in ``salts`` of the readings is measured as hot: its readings are spread
    over ``salts`` keys, each of which gets a copy of its rules. All other rules
    stay single. Adaptive execution splits what is still skewed.

    Where a metric has more than ``CROWDED`` rules, readings meet sorted arrays of
    them instead and search these, so the work follows the alerts.
    """
    observed = readings.withColumn("observed_int", truncated_int(F.col("value")))
    if rules.most > CROWDED:
        return _searched(observed, rules, salts)
    limits = rules.frame.select(
        F.col("metrics"),
        F.col("value").alias("threshold"),
        F.col("mod"),
        truncated_int(F.col("value")).alias("threshold_int"),
    )
    if rules.small:
        joined = observed.join(F.broadcast(limits), "metrics")
    else:
        observed, copies = _salted(observed, limits, salts)
        joined = observed.join(copies.hint("merge"), ["metrics", "salt"])
    return joined.where(fires(F.col("observed_int"), F.col("threshold_int"), F.col("mod")))


def _salted(readings: DataFrame, limits: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: that of a hot metric's reading is one of many, and all have its rules."""
    is_hot = F.col("metrics").isin(hot_metrics(readings, salts))
    # A hash of the row and not rand(): a recomputed task must salt alike.
    spread = F.pmod(F.xxhash64("messageid", "name", "value"), F.lit(salts)).cast("int")
    own = F.when(is_hot, spread).otherwise(0)
    top = F.when(is_hot, salts - 1).otherwise(0)
    copies = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), top)))
    return readings.withColumn("salt", own), copies


def _searched(observed: DataFrame, rules: RuleSet, salts: int) -> DataFrame:
    blocks = threshold_blocks(rules.frame, rules.most)
    # Parts are dealt by digest, so one may hold more than its share, but not all of it.
    steps = min(rules.most, 64 * BLOCK).bit_length()
    if rules.small:
        return broken_rules(observed, F.broadcast(blocks), steps, ["metrics"])
    observed, copies = _salted(observed, blocks, salts)
    return broken_rules(observed, copies.hint("merge"), steps, ["metrics", "salt"])


def hot_metrics(readings: DataFrame, salts: int) -> list[str]:
    """Metrics with more than one in ``salts`` of the readings: fewer than ``salts``.

    One pass over one column, combined before the shuffle.
    """
    counts = readings.groupBy("metrics").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.where((F.col("n") * salts > total) & F.col("metrics").isNotNull())
    return sorted(r["metrics"] for r in top.collect())


def alerts(readings: DataFrame, rules: RuleSet, salts: int = SALTS) -> DataFrame:
    """The alert as it is published: ``value`` is the threshold that was broken."""
    return match_rules(readings, rules, salts).select(
        "name", "metrics", F.col("threshold").alias("value")
    )


def alert_details(readings: DataFrame, rules: RuleSet, salts: int = SALTS) -> DataFrame:
    """The alert with the reading that raised it."""
    return match_rules(readings, rules, salts).select(
        "messageid", "messagedate", "name", "metrics", "value", "threshold", "mod"
    )


@contextmanager
def _lenient_casts(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def run_rule_text(
    spark: SparkSession, text: str, views: Iterable[str] | None = None
) -> DataFrame:
    """Run a user's rule query, written for the older lenient casts.

    With ``views`` a text that is more than one query over these is refused before
    anything of it runs, and so is one that pairs all rows of two tables.

    There ``int('190.857')`` is 190 and ``int('abc')`` is NULL; the default of
    today's Spark raises an error for both. A cast keeps the mode it was analysed
    with, so the setting is needed during analysis only.
    """
    text = text.strip().rstrip(";")
    if views is not None:
        check_text(spark, text, views)
    with _lenient_casts(spark):
        found = spark.sql(text)
    if views is not None:
        check_plan(found)
    return found
