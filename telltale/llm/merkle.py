"""A Merkle manifest of a table, with a proof for every row by pointer jumping.

Rows are leaves; leaves of one source form a tree, and the tops of these trees
form one more tree above them. Digests are lowercase hexadecimal SHA-256 of their inputs
one after the other. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telltale.llm.ordering import block, join_blocks, numbered
from telltale.llm.tasks import stored

ARITY = 16
HEX = 64
# The tree above those of the sources; theirs are numbered from 0 on.
TOP = -1

_ID = ("tree", "level", "i")
_UP = ("up_tree", "up_level", "up_i")
_STEP = "array<struct<place:int,siblings:string>>"


def field_bytes(value: Column) -> Column:
    """A value as it goes into a digest: ``-`` for NULL, else its byte count, ``:`` and itself."""
    text = value.cast("string")
    marked = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(marked, F.lit("-"))


def row_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_bytes(v) for v in values]), 256)


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf to the root and left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: s["siblings"]), ""), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings of a proof give."""

    def fold(digest: Column, step: Column) -> Column:
        left = step["place"] * HEX
        siblings = step["siblings"]
        before = F.substring(siblings, F.lit(1), left)
        after = F.substring(siblings, left + 1, F.length(siblings))
        return F.sha2(F.concat(before, digest, after), 256)

    return F.aggregate(steps, leaf, fold)


@dataclass(frozen=True)
class Manifest:
    """``proofs`` has a row per leaf: what was given, ``subroot``, ``root`` and ``steps``.

    ``steps`` lists, from the leaf upwards, the place of the node in its run and the digests of
    the others of the run, left to right. ``nodes`` has every node above the leaves, and the tops of the sources, with its digest ``h``.
    """

    proofs: DataFrame
    nodes: DataFrame


def manifest(leaves: DataFrame, group: str, order: str, leaf: str, arity: int = ARITY) -> Manifest:
    """Build the trees and prove every row of ``leaves``.

    Leaves of a ``group`` ascend by ``order``, NULL first, equal ones by their
    digest; repeated rows are leaves of their own. Groups ascend by their UTF-8 bytes, the NULL group first. Every ``arity``
    nodes in a row become their digest, the last ones of a level too if they are
    fewer, until one is left. An empty table gives no rows. The other columns are kept.
    """
    kept = [f"kept{i}" for i in range(len(leaves.columns))]
    names = dict(zip(leaves.columns, kept, strict=True))
    group, order, leaf = names[group], names[order], names[leaf]
    tagged = leaves.toDF(*kept).withColumns(
        {"known": F.col(group).isNotNull(), "source": F.coalesce(F.col(group).cast("string"), F.lit(""))}
    )
    keys = [F.col("known"), F.col("source"), F.col(order).asc_nulls_first(), F.col(leaf)]
    at = numbered(tagged, keys, "leaves")
    spans = at.groupBy("known", "source").agg(F.min("idx").alias("first"), F.count("*").alias("n"))
    spans = numbered(spans, [F.col("known"), F.col("source")], "sources", into="tree")
    n_trees = spans.count()
    placed = join_blocks(at, spans, ["known", "source"], [block("idx")])
    member = F.struct((F.col("idx") - F.col("first")).alias("i"), F.col(leaf).alias("h"), *kept)
    placed = placed.select("tree", "n", (F.col("idx") - F.col("first")).alias("i"), member.alias("member"))
    runs = stored(_runs(placed, arity), "leaf-runs")

    # What stands for a run above its leaves: their digest, or the only leaf itself.
    first = runs.select("tree", "level", F.col("up").alias("i"), "h", "n")
    paths = _jump(_climb(first, arity, n_trees))
    ways = paths.select("tree", "level", F.col("i").alias("up"), "subroot", "root", "steps")
    each = runs.select("tree", "level", "up", "members").join(ways, ["tree", "level", "up"]).select(
        "level", "members", "subroot", "root", "steps", F.posexplode("members").alias("place", "member")
    )
    first = F.array(_step(F.col("members"), F.col("place"))).cast(_STEP)
    proofs = each.select(
        *[F.col(f"member.{k}").alias(c) for c, k in names.items()],
        "subroot",
        "root",
        F.when(F.col("level") == 0, F.col("steps")).otherwise(F.concat(first, "steps")).alias("steps"),
    )
    return Manifest(proofs, paths.select(*_ID, "h"))


def _runs(placed: DataFrame, arity: int) -> DataFrame:
    """Runs of nodes with the digest of each: (tree, level, up, h, n of the level above, members).

    At most ``arity`` members meet in a group. A node that is alone in its tree stays on its level.
    """
    alone = F.col("n") == 1
    keyed = placed.withColumns(
        {
            "up": F.floor(F.col("i") / arity).cast("bigint"),
            "above": F.ceil(F.col("n") / arity).cast("bigint"),
            "level": F.when(alone, 0).otherwise(1).cast("bigint"),
        }
    )
    found = keyed.groupBy("tree", "level", "up", F.col("above").alias("n")).agg(
        F.sort_array(F.collect_list("member")).alias("members")
    )
    only_leaf = F.col("members")[0]["h"]
    return found.withColumn("h", F.when(F.col("level") == 0, only_leaf).otherwise(_together()))


def _together() -> Column:
    return F.sha2(F.array_join(F.transform("members", lambda m: m["h"]), ""), 256)


def _step(members: Column, place: Column) -> Column:
    """The others of a run, left to right, and where the node itself stands."""
    digests = F.transform(members, lambda m: m["h"])
    before = F.slice(digests, F.lit(1), place)
    after = F.slice(digests, place + 2, F.size(members))
    siblings = F.array_join(F.concat(before, after), "")
    return F.struct(place.cast("int").alias("place"), siblings.alias("siblings"))


def _climb(first: DataFrame, arity: int, n_trees: int) -> DataFrame:
    """All nodes from the first digests up to the root, each with the step to the node above.

    One level after the other over all trees at once; a level has 1/arity of the rows
    of the one below. The tops of the sources are the leaves of one more tree.
    """
    nodes, tops = [], []
    now = first.withColumn("id", F.struct(*_ID))
    while True:
        tops.append(now.where("n = 1"))
        steps, now = _level(now.where("n > 1"), arity)
        nodes.append(steps)
        if now.isEmpty():
            break
    now = reduce(DataFrame.unionByName, tops).select(
        "id",
        F.lit(TOP).cast("bigint").alias("tree"),
        F.lit(0).cast("bigint").alias("level"),
        F.col("tree").alias("i"),
        F.lit(n_trees).cast("bigint").alias("n"),
        "h",
    )
    while True:
        nodes.append(_last(now.where("n = 1")))
        steps, now = _level(now.where("n > 1"), arity)
        nodes.append(steps)
        if now.isEmpty():
            break
    whole = reduce(DataFrame.unionByName, nodes)
    return stored(whole.withColumn("root", F.when(F.col("up_tree").isNull(), F.col("h"))), "nodes")


def _subroot() -> Column:
    """The digest of the top of a source, at the row in which it is a leaf of the top tree."""
    return F.when((F.col("tree") == TOP) & (F.col("level") == 0), F.col("h")).alias("subroot")


def _last(now: DataFrame) -> DataFrame:
    """The node that has none above it."""
    nothing = F.lit(None).cast("bigint")
    steps = F.array().cast(_STEP).alias("steps")
    return now.select("id.*", "h", *[nothing.alias(c) for c in _UP], steps, _subroot())


def _level(now: DataFrame, arity: int) -> tuple[DataFrame, DataFrame]:
    """The steps of the nodes of a level, and the nodes of the level above."""
    runs = now.groupBy(
        "tree",
        "level",
        F.floor(F.col("i") / arity).cast("bigint").alias("up"),
        F.ceil(F.col("n") / arity).cast("bigint").alias("above"),
    ).agg(F.sort_array(F.collect_list(F.struct("i", "h", "id"))).alias("members"))
    runs = stored(runs, "runs").withColumn("over", F.col("level") + 1)
    each = runs.select("*", F.posexplode("members").alias("place", "member"))
    each = each.select("*", "member.h", "member.id")
    steps = each.select(
        "id.*",
        "h",
        F.col("tree").alias("up_tree"),
        F.col("over").alias("up_level"),
        F.col("up").alias("up_i"),
        F.array(_step(F.col("members"), F.col("place"))).cast(_STEP).alias("steps"),
        _subroot(),
    )
    here = F.struct("tree", F.col("over").alias("level"), F.col("up").alias("i"))
    after = runs.select(
        here.alias("id"), "tree", F.col("over").alias("level"), F.col("up").alias("i"),
        F.col("above").alias("n"), _together().alias("h"),
    )
    return steps, after


def _jump(nodes: DataFrame) -> DataFrame:
    """Double the distance every node knows its way up for, until all ways end at the root.

    After a round a node points to what the node it pointed to pointed to, and its steps
    go on with that node's. The digests of the top of the source and of the root come along
    where they are passed. Many nodes point to one, so pointers are joined in blocks of nodes that lie
    together.
    """
    while not nodes.where("up_tree IS NOT NULL").isEmpty():
        ahead = nodes.select(
            *[F.col(c).alias(u) for c, u in zip(_ID, _UP, strict=True)],
            *[F.col(u).alias(f"next_{u}") for u in _UP],
            F.col("steps").alias("more"),
            F.col("subroot").alias("next_subroot"),
            F.col("root").alias("next_root"),
        )
        pointing = nodes.where("up_tree IS NOT NULL")
        moved = join_blocks(pointing, ahead, list(_UP), [F.col("tree"), block("i")]).select(
            *_ID,
            "h",
            *[F.col(f"next_{u}").alias(u) for u in _UP],
            F.concat("steps", "more").alias("steps"),
            F.coalesce("subroot", "next_subroot").alias("subroot"),
            F.coalesce("root", "next_root").alias("root"),
        )
        nodes = stored(nodes.where("up_tree IS NULL").unionByName(moved), "jumps")
    return nodes
