"""Readings against very many thresholds of one metric.

The thresholds of a metric lie in sorted arrays of bounded length. For a reading the
place of its value in each array is found by halving, and what it breaks is one
stretch of the array, so beyond the search only the alerts are made. A plain join would
make a row for each reading and rule and throw most of them away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telltale.functions.numbers import truncated_int

# Thresholds of an array, at most about so many.
BLOCK = 1024
_SIDES = ("above", "below", "equal")


def threshold_blocks(rules: DataFrame, most: int, block: int = BLOCK) -> DataFrame:
    """``(metrics, part, above, below, equal)``: sorted arrays of (limit, threshold, mod).

    A rule is in ``above`` if its mode raises values over the limit, in ``below`` if it raises those
    under it, in ``equal`` if only the same value. ``most`` is how many rules a metric has
    at most; they are dealt over so many parts that a part has about ``block``. A
    threshold that is no number is broken by nothing and left out.
    """
    parts = max(1, -(-most // block))
    rows = rules.select(
        "metrics",
        F.pmod(F.xxhash64("value", "mod"), F.lit(parts)).cast("int").alias("part"),
        F.struct(
            truncated_int(F.col("value")).alias("limit"), F.col("value").alias("threshold"), "mod"
        ).alias("rule"),
    ).where("rule.limit IS NOT NULL")
    mod = F.col("rule.mod")
    wanted = dict(zip(_SIDES, (mod.contains("gt"), mod.contains("lt"), mod == "eq"), strict=True))
    return rows.groupBy("metrics", "part").agg(
        *[F.sort_array(F.collect_list(F.when(is_one, F.col("rule")))).alias(side) for side, is_one in wanted.items()]
    )


def _count_while(rules: Column, steps: int, holds) -> Column:
    """How many rules at the start of a sorted array hold; halving, in so many steps."""
    size = F.size(rules)

    def step(low: Column, width: Column) -> Column:
        high = low + width
        further = F.when(high <= size, holds(F.get(rules, high - 1)["limit"])).otherwise(False)
        return F.when(further, high).otherwise(low)

    widths = F.array(*[F.lit(1 << i) for i in range(steps - 1, -1, -1)])
    return F.aggregate(widths, F.lit(0), step)


def broken_rules(observed: DataFrame, blocks: DataFrame, steps: int, on: list[str]) -> DataFrame:
    """``observed`` with ``threshold`` and ``mod`` of every rule that ``observed_int`` breaks.

    ``steps`` is the number of binary digits of the longest array.
    """
    seen = F.col("observed_int")
    met = observed.where(seen.isNotNull()).join(blocks, on)
    above, below, equal = (F.col(s) for s in _SIDES)
    under = _count_while(above, steps, lambda limit: limit < seen)
    upto = _count_while(below, steps, lambda limit: limit <= seen)
    less = _count_while(equal, steps, lambda limit: limit < seen)
    same = _count_while(equal, steps, lambda limit: limit <= seen)
    met = met.withColumns({"under": under, "upto": upto, "less": less, "same": same})
    stretch = F.concat(
        F.slice(above, F.lit(1), F.col("under")),
        F.slice(below, F.col("upto") + 1, F.size(below)),
        F.slice(equal, F.col("less") + 1, F.col("same") - F.col("less")),
    )
    return met.select(*observed.columns, F.explode(stretch).alias("rule")).select(
        *observed.columns, "rule.threshold", "rule.mod"
    )
