"""The trie of conversation prefixes, and sums over its subtrees from an Euler tour.

Every node is a distinct sequence of first turns. A node is entered and left once
on a tour of the tree; the tour is a linked list of these arcs. Ranking the list
gives every arc its place, and running sums along the places give the sum over a
subtree as what was added between entering its top and leaving it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telltale.llm.ordering import block, join_blocks, numbered
from telltale.llm.tasks import only, ship, stored, word_count

# A prefix is known by four sums of 31 bits each: 124 bits and its depth.
_LANES = ("lane0", "lane1", "lane2", "lane3")
_LANE = 1 << 31
# A list of so many arcs is ranked in one task.
SHORT_LIST = 10_000
# So many ids are joined into one text before the texts of a node are digested in order.
IDS_PER_TEXT = 4096


# Turns and rebuilt conversations


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, turn_digest, words, idx)`` of every turn, places from 1 on.

    Turns follow their number, NULL first; turns of one number follow their role, then the digest of their
    text, so repeated rows are turns of their own. NULL roles and texts are
    empty. Rows without a conversation are left out.
    """
    turns = only(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    narrow = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.unhex(F.sha2(whole, 256)).alias("turn_digest"),
        word_count(F.col("text")).alias("words"),
    )
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("turn_digest")]
    at = numbered(narrow, keys, "turns")
    starts = at.groupBy("conv_id").agg(F.min("idx").alias("first"))
    placed = join_blocks(at, starts, ["conv_id"], [block("idx")]).select(
        "conv_id", (F.col("idx") - F.col("first") + 1).alias("place"), "turn_digest", "words", "idx"
    )
    return stored(placed, "turns-placed")


def shared_heads(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Give each conversation the first turns of its family's first one.

    Conversation c takes the first h turns of c - c % family, all if there are fewer,
    with h the unsigned CRC-32 of its number modulo ``most``, and goes on with its own
    turns after its first h. Returns the rebuilt turns
    ``(conv_id, depth, turn_digest, words)`` and ``(conv_id, n_turns)``.
    """
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % family, "h": h})
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    given = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("given", given)
    convs = stored(convs.drop("n_base"), "conversations")
    own = join_blocks(turns, convs, ["conv_id"], [block("idx")]).where("place > h")
    own = own.select(
        "conv_id", (F.col("place") - F.col("h") + F.col("given")).alias("depth"), "turn_digest", "words"
    )
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("place") < most))
    heads = heads.select(F.col("conv_id").alias("base"), "place", "turn_digest", "words")
    # No more conversations than two families, and fewer turns than ``most``.
    taken = convs.select("conv_id", "base", "given").join(heads, "base").where("place <= given")
    taken = taken.select("conv_id", F.col("place").alias("depth"), "turn_digest", "words")
    rest = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return own.unionByName(taken), convs.select("conv_id", (F.col("given") + rest).alias("n_turns"))


def _prefixes(turns: DataFrame) -> DataFrame:
    """Every rebuilt turn with the sums that stand for the prefix it ends.

    A turn at a depth has four numbers of 31 bits, and a prefix the sums of those of its turns modulo
    2^31: running sums over all conversations, less the sum before the conversation.
    """
    mixes = [F.xxhash64("turn_digest", "depth", F.lit(i)) for i in (1, 2)]
    lanes = [
        bits.bitwiseAND(F.lit(_LANE - 1))
        for mix in mixes
        for bits in (mix, F.shiftrightunsigned(mix, 33))
    ]
    numbers = turns.select(
        "conv_id", "depth", "words", *[x.alias(c) for c, x in zip(_LANES, lanes, strict=True)]
    )
    keys = [F.col("conv_id"), F.col("depth")]
    at = stored(numbered(numbers, keys, "prefixes", sums=_LANES, modulus=_LANE), "prefixes-at")
    before = [
        F.pmod(F.col(f"run_{c}") - F.col(c), F.lit(_LANE)).alias(f"before_{c}") for c in _LANES
    ]
    starts = at.where("depth = 1").select("conv_id", *before)
    joined = join_blocks(at, starts, ["conv_id"], [block("idx")])

    def since(c: str, own: Column | int = 0) -> Column:
        return F.pmod(F.col(f"run_{c}") - F.col(f"before_{c}") - own, F.lit(_LANE))

    key = [since(c) for c in _LANES]
    parent = [since(c, F.col(c)) for c in _LANES]
    return joined.select(
        "conv_id",
        "depth",
        "words",
        _key(F.col("depth"), key).alias("key"),
        _key(F.col("depth") - 1, parent).alias("parent_key"),
    )


def _root() -> Column:
    return _key(F.lit(0), [F.lit(0).cast("bigint")] * 4)


def _key(depth: Column, lanes: Sequence[Column]) -> Column:
    a, b, c, d = lanes
    return F.struct(
        depth.cast("bigint").alias("depth"),
        F.shiftleft(a, 31).bitwiseOR(b).alias("high"),
        F.shiftleft(c, 31).bitwiseOR(d).alias("low"),
    )


# List ranking


def list_ranks(links: DataFrame, short: int = SHORT_LIST) -> DataFrame:
    """``(arc, place)`` for a list ``links(arc long, next long)`` whose last ``next`` is NULL.

    An arc whose coin shows tails goes out of the list if the one before it shows heads; the
    one before then points past it and knows the distance. About a quarter of the arcs
    goes out in a round, so all rounds together read some four times the list.
    When ``short`` arcs or fewer are left they are walked in one task. Then the
    rounds are undone: an arc that went out lies where the one before it
    lies plus the distance at the time. Every round is written.
    """
    def heads(arc: str, turn: int) -> Column:
        return F.xxhash64(F.col(arc), F.lit(turn)).bitwiseAND(F.lit(1)) == 0

    left = stored(links.select("arc", "next", F.lit(1).cast("bigint").alias("step")), "tour")
    n, turn, out = left.count(), 0, []
    while n > short:
        # The last arc has no next one and takes nothing in.
        takes = heads("arc", turn) & F.col("next").isNotNull() & ~heads("next", turn)
        takers = left.where(takes).select(
            F.col("arc").alias("before"), F.col("next").alias("arc"), F.col("step").alias("off")
        )
        met = left.where(~heads("arc", turn)).join(takers, "arc", "left")
        gone = F.col("before").isNotNull()
        met = met.select(
            F.coalesce("before", "arc").alias("arc"),
            "next",
            (F.col("step") + F.coalesce("off", F.lit(0))).alias("step"),
            F.when(gone, F.col("arc")).alias("gone"),
            "off",
        )
        rest = left.where(heads("arc", turn) & ~F.coalesce(takes, F.lit(False)))
        nothing = F.lit(None).cast("bigint")
        both = met.unionByName(rest.withColumns({"gone": nothing, "off": nothing}))
        both = stored(both, "tour")
        out.append(both.where("gone IS NOT NULL").select(F.col("gone").alias("arc"), F.col("arc").alias("before"), "off"))
        left = both.select("arc", "next", "step")
        n, turn = left.count(), turn + 1
    found = stored(_walked(left), "places")
    for goes in reversed(out):
        at = found.select(F.col("arc").alias("before"), "place")
        more = goes.join(at, "before").select("arc", (F.col("place") + F.col("off")).alias("place"))
        found = found.unionByName(stored(more, "places"))
    return found


def _walked(links: DataFrame) -> DataFrame:
    """Places of the arcs of a list short enough for one task."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after = {}
        for batch in batches:
            rows = (batch.column(c).to_pylist() for c in ("arc", "next", "step"))
            after |= {a: (n, s) for a, n, s in zip(*rows, strict=True)}
        arcs, places, place = [], [], 0
        arc = next(iter(after.keys() - {n for n, _ in after.values()}), None)
        while arc is not None:
            arcs.append(arc)
            places.append(place)
            arc, step = after[arc]
            place += step
        yield pa.record_batch([pa.array(arcs, pa.int64()), pa.array(places, pa.int64())], ["arc", "place"])

    return links.coalesce(1).mapInArrow(walk, "arc long, place long")


# The trie


def prefix_trie(turns: DataFrame, convs: DataFrame, short: int = SHORT_LIST) -> DataFrame:
    """One row per node of the trie of some conversations.

    ``turns(conv_id, depth, turn_digest, words)`` has depths from 1 on without gaps,
    ``convs(conv_id, n_turns)`` every conversation once, those without turns as well. The root is the node of
    depth 0; without conversations there is no node at all. ``saved_tokens`` of a node
    is the words of the last turn of each node below it, its own too, times the
    conversations but one that share that node. ``ends_sha256`` digests the ids of the
    conversations that end there.
    """
    ship(turns.sparkSession)
    rows = stored(_prefixes(turns), "prefixes")
    columns = ("conv_id", "words", "key", "parent_key.high", "parent_key.low")
    nothing = F.lit(0).cast("bigint")
    tops = convs.select(
        "conv_id", nothing.alias("words"), _root().alias("key"), nothing.alias("high"), nothing.alias("low")
    )
    # All rows of a node have the same words and parent.
    grouped = rows.select(*columns).unionByName(tops).groupBy("key").agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        F.max("high").alias("high"),
        F.max("low").alias("low"),
    )
    parent = F.struct((F.col("key.depth") - 1).alias("depth"), "high", "low")
    grouped = grouped.withColumn("parent_key", F.when(F.col("key.depth") > 0, parent)).drop("high", "low")
    # Siblings lie together, so the next one has the next number.
    order = [F.col("parent_key").asc_nulls_first(), F.col("key")]
    nodes = numbered(grouped, order, "nodes")
    kids = nodes.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(
        F.count("*").alias("n_children"), F.min("idx").alias("first_child")
    )
    nodes = stored(nodes.join(kids, "key", "left").fillna({"n_children": 0}), "nodes")
    parents = nodes.select(
        F.col("key").alias("parent_key"),
        F.col("idx").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
        (F.col("first_child") + F.col("n_children") - 1).alias("last_sibling"),
    )
    nodes = stored(join_blocks(nodes, parents, ["parent_key"], [block("idx")], "left"), "nodes")

    # Arc 2 i enters node i, arc 2 i + 1 leaves it.
    enter, leave = F.col("idx") * 2, F.col("idx") * 2 + 1
    down = F.coalesce(F.col("first_child") * 2, leave)
    beside = F.when(F.col("idx") < F.col("last_sibling"), enter + 2).otherwise(F.col("parent") * 2 + 1)
    arcs = F.array(
        F.struct(enter.alias("arc"), down.alias("next")), F.struct(leave.alias("arc"), beside.alias("next"))
    )
    places = list_ranks(nodes.select(F.inline(arcs)), short)

    # What is added on entering a node; nothing on leaving it.
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint")
    saved = (F.col("n_convs") - 1) * F.col("words")
    added = nodes.select(enter.alias("arc"), leaf.alias("leaves"), saved.alias("saved"))
    along = places.join(added, "arc", "left").fillna(0, ["leaves", "saved"])
    sums = numbered(along, [F.col("place")], "tour-sums", sums=("leaves", "saved"))

    def between(c: str) -> Column:
        return F.max(f"run_{c}") - F.min(F.col(f"run_{c}") - F.col(c))

    below = sums.groupBy(F.floor(F.col("arc") / 2).cast("bigint").alias("idx")).agg(
        between("leaves").alias("n_leaves"), between("saved").alias("saved_tokens")
    )
    full = nodes.join(below, "idx").join(_ends(rows, convs), "key", "left")
    return full.select(
        "conv_id",
        F.col("key.depth").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def _ends(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of the nodes at which conversations end.

    Ids are put in order over all tasks and joined into texts of bounded length. SHA-256 has to
    read its input in order, so the few nodes with more than one text are digested
    text by text, one node in one task: what that task holds is one text.
    """
    last = rows.select("conv_id", "depth", "key").join(
        convs.select("conv_id", F.col("n_turns").alias("depth")), ["conv_id", "depth"]
    )
    ends = last.select("conv_id", "key").unionByName(
        convs.where("n_turns = 0").select("conv_id", _root().alias("key"))
    )
    at = numbered(ends, [F.col("key"), F.col("conv_id")], "ends")
    texts = at.groupBy("key", F.floor(F.col("idx") / IDS_PER_TEXT).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    texts = stored(texts, "ends")
    counted = texts.join(texts.groupBy("key").agg(F.count("*").alias("n")), "key")
    one = counted.where("n = 1").select("key", F.sha2("ids", 256).alias("ends_sha256"))
    many = counted.where("n > 1").select(F.to_json("key").alias("name"), "key", "part", "ids")
    digested = many.repartition("name").sortWithinPartitions("name", "part").select("name", "ids")
    digested = digested.mapInArrow(_in_order, "name string, ends_sha256 string")
    named = many.select("key", "name").distinct()
    return one.unionByName(named.join(digested, "name").select("key", "ends_sha256"))


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, state = None, None
    done: list[tuple[str, str]] = []
    for batch in batches:
        for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if name != now:
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = name, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if state is not None:
        done.append((now, state.hexdigest()))
    names, digests = ([d[i] for d in done] for i in (0, 1))
    yield pa.record_batch([pa.array(names, pa.string()), pa.array(digests, pa.string())], ["name", "ends_sha256"])
