"""Connected components of links, by stars that alternate between larger and smaller ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telltale.llm.tasks import stored

MAX_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a long, b long)``; the root is the smallest.

    A round joins the larger neighbours of every node to its smallest neighbour,
    then the smaller ones. Minima are summed in the tasks before the shuffle and
    joined back, so a node with very many links is neither collected nor kept in
    one task. Every round is written to the shared folder; only two numbers come
    to the driver. Links of a node to itself and NULLs are left out.
    """
    edges = stored(_tidy(links), "links")
    before = _digest(edges)
    for _ in range(MAX_ROUNDS):
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _digest(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.withColumn("root", F.col("node"))
    )


def _tidy(links: DataFrame) -> DataFrame:
    """Links once, from the larger to the smaller node."""
    return (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the node's smallest neighbour or itself."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("low"))
    # A node that is the smaller end everywhere is its own smallest.
    at = edges.select(F.col("b").alias("node"), F.col("a").alias("larger"))
    joined = at.join(smallest.withColumnRenamed("a", "node"), "node", "left")
    low = F.coalesce("low", "node")
    return _tidy(joined.select(F.col("larger").alias("a"), low.alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, goes to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("low"))
    joined = edges.join(smallest, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
    return _tidy(moved.unionByName(smallest.select("a", F.col("low").alias("b"))))


def _digest(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())
