"""Exact length histogram of an encoded corpus, and what it answers for any context limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telltale.llm.bpe import count_ids

# Lengths that share a partition while sums run over them.
LENGTHS_PER_BLOCK = 4096


def length_histogram(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``(length, n_docs)`` for every encoded length that occurs.

    A NULL text counts as an empty one, of length 0; repeated rows count each
    time. Lengths leave the tasks summed, so the shuffle is as small as the
    number of distinct lengths.
    """
    return (
        count_ids(docs, tokenizer, text)
        .groupBy(F.col("n_tokens").alias("length"))
        .agg(F.count("*").alias("n_docs"))
    )


def length_sums(histogram: DataFrame) -> DataFrame:
    """For every length the documents and tokens up to it and beyond it.

    Sums run inside blocks of lengths and then over the totals of the blocks, so
    no task holds all lengths. An empty histogram gives no rows.

    ``docs_upto``, ``tokens_upto``: documents of at most this length, their
    tokens. ``docs_beyond``: longer documents. ``tokens_kept``: tokens left if
    every document is cut to this length. ``quantile``: the share of documents
    that fit whole.
    """
    block = F.floor(F.col("length") / LENGTHS_PER_BLOCK)
    rows = histogram.withColumn("block", block).withColumn(
        "n_tokens", F.col("length") * F.col("n_docs")
    )
    blocks = rows.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum("n_tokens").alias("block_tokens")
    )
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("block_tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("block_docs").over(everything.orderBy("block")).alias("docs"),
        F.sum("block_tokens").over(everything.orderBy("block")).alias("tokens"),
    )
    inside = Window.partitionBy("block").orderBy("length")
    running = rows.withColumn("docs_in", F.sum("n_docs").over(inside)).withColumn(
        "tokens_in", F.sum("n_tokens").over(inside)
    )
    docs_upto = F.col("docs_before") + F.col("docs_in")
    tokens_upto = F.col("tokens_before") + F.col("tokens_in")
    beyond = F.col("docs") - docs_upto
    return running.join(offsets, "block").select(
        "length",
        "n_docs",
        docs_upto.alias("docs_upto"),
        beyond.alias("docs_beyond"),
        tokens_upto.alias("tokens_upto"),
        (tokens_upto + beyond * F.col("length")).alias("tokens_kept"),
        F.col("docs").alias("docs"),
        F.col("tokens").alias("tokens"),
        (docs_upto / F.col("docs")).alias("quantile"),
    )


def truncated_totals(sums: DataFrame, limits: DataFrame) -> DataFrame:
    """``limits(limit)`` with the documents cut at each limit and the tokens kept.

    A limit between two lengths is answered from the largest length below it:
    every longer document keeps exactly ``limit`` tokens. One sorted pass carries
    that length to the limits, so there is no join. NULL or negative limits are
    dropped; below the smallest length every document is cut.
    """
    asked = limits.select(F.col("limit").cast("long")).where("limit >= 0").distinct()
    at = sums.select(
        F.col("length").alias("at"), F.lit(0).alias("kind"), "docs_upto", "tokens_upto"
    ).unionByName(
        asked.select(F.col("limit").alias("at"), F.lit(1).alias("kind")),
        allowMissingColumns=True,
    )
    # Limits are a list that somebody wrote; lengths are first carried inside blocks.
    whole = sums.agg(F.max("docs").alias("docs"), F.max("tokens").alias("tokens"))
    block = F.floor(F.col("at") / LENGTHS_PER_BLOCK)
    inside = Window.partitionBy("block").orderBy("at", "kind")
    carried = at.withColumn("block", block).select(
        "at",
        "kind",
        "block",
        F.last("docs_upto", True).over(inside).alias("docs_upto"),
        F.last("tokens_upto", True).over(inside).alias("tokens_upto"),
    )
    ends = carried.groupBy("block").agg(
        F.max("docs_upto").alias("end_docs"), F.max("tokens_upto").alias("end_tokens")
    )
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        "block",
        F.coalesce(F.max("end_docs").over(before), F.lit(0)).alias("start_docs"),
        F.coalesce(F.max("end_tokens").over(before), F.lit(0)).alias("start_tokens"),
    )
    docs_upto = F.coalesce("docs_upto", "start_docs")
    beyond = F.coalesce("docs", F.lit(0)) - docs_upto
    return (
        carried.where("kind = 1")
        .join(starts, "block")
        .crossJoin(F.broadcast(whole))
        .select(
            F.col("at").alias("limit"),
            docs_upto.alias("docs_whole"),
            beyond.alias("docs_cut"),
            (F.coalesce("tokens_upto", "start_tokens") + beyond * F.col("at")).alias("tokens_kept"),
        )
    )


def length_quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """For every share the smallest length that so many documents do not exceed."""
    asked = F.explode(F.array(*[F.lit(float(s)) for s in sorted(set(shares))]))
    return (
        sums.select("length", "quantile", asked.alias("share"))
        .where(F.col("quantile") >= F.col("share"))
        .groupBy("share")
        .agg(F.min("length").alias("length"))
    )
