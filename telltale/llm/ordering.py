"""Total orders over whole tables: dense numbers, running sums and joins whose keys may be hot.

All of it is DataFrame functions. Nothing here gathers a group in one task: rows
are dealt out by ranges of the sort keys, so a group of any size lies in as many
tasks as its rows need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telltale.llm.tasks import stored

# So many rows are numbered in one task.
ROWS_PER_PART = 500_000
# So many rows with the same key meet in one task at most.
ROWS_PER_BLOCK = 256
# monotonically_increasing_id() has the task above and the row of the task below.
_ROW_BITS = 33


def numbered(
    frame: DataFrame,
    keys: Sequence[Column],
    label: str,
    into: str = "idx",
    sums: Sequence[str] = (),
    modulus: int | None = None,
) -> DataFrame:
    """Add the place of every row in the order of ``keys``, from 0 on without gaps.

    ``sums`` names whole-number columns without NULLs; ``run_<name>`` becomes the
    sum up to and with the row, modulo ``modulus`` if it is given. Rows with equal
    keys get places in any order, and are spread over tasks like all others. The rows
    are written once before they are dealt out, since finding the ranges reads them
    too, and once in order, so a lost task gives the same places again.
    """
    spark = frame.sparkSession
    held = stored(frame.withColumn("__tie", F.monotonically_increasing_id()), f"{label}-rows")
    parts = -(-held.count() // ROWS_PER_PART)
    parts = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [*keys, F.col("__tie").asc()]
    dealt = held.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("__tie")
    dealt = stored(dealt.withColumn("__at", F.monotonically_increasing_id()), label)
    dealt = dealt.withColumn("__part", F.shiftright("__at", _ROW_BITS))

    def bounded(total: Column) -> Column:
        return total if modulus is None else F.pmod(total, F.lit(modulus))

    # One row for each task of the sort.
    totals = dealt.groupBy("__part").agg(
        F.count("*").alias("__n"), *[bounded(F.sum(c)).alias(f"__sum_{c}") for c in sums]
    )
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__part",
        *[
            F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast("bigint").alias(c)
            for c in ("__n", *(f"__sum_{c}" for c in sums))
        ],
    )
    offsets = stored(offsets, f"{label}-offsets")
    found = dealt.join(F.broadcast(offsets), "__part")
    # Without sums the result is a scan; with them it takes one more shuffle.
    upto = Window.partitionBy("__part").orderBy("__at")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return found.select(
        *frame.columns,
        (F.col("__n") + row).alias(into),
        *[
            bounded(F.col(f"__sum_{c}") + F.sum(c).over(upto)).cast("bigint").alias(f"run_{c}")
            for c in sums
        ],
    )


def block(place: str) -> Column:
    """The block of a place; places of one group lie together, so a block holds few of them."""
    return F.floor(F.col(place) / ROWS_PER_BLOCK).cast("bigint")


def join_blocks(
    many: DataFrame, one: DataFrame, keys: Sequence[str], blocks: Sequence[Column], how: str = "inner"
) -> DataFrame:
    """Join on keys that are unique in ``one`` and may be held by any share of ``many``.

    ``blocks`` cuts the rows of a key into pieces. The row of ``one`` is copied to the
    blocks that occur, and both are dealt out by key and block. ``many`` is read
    twice, so it should be a written table.
    """
    names = [f"__block_{i}" for i in range(len(blocks))]
    cut = many.withColumns(dict(zip(names, blocks, strict=True)))
    wanted = cut.select(*keys, *names).distinct()
    copies = wanted.join(one, list(keys))
    return cut.join(copies, [*keys, *names], how).drop(*names)
