"""Near copies by SimHash: fingerprints that differ in few bits are linked.

Candidates come from anchors. The 64 bits are cut into parts such that of two
fingerprints within the distance at least one part differs in one bit or less.
The code words of a perfect Hamming code over the bits of a part are the
anchors: every value lies within one bit of exactly one of them (the covering
radius), its home. A fingerprint goes to its home, and as a visitor to every
anchor within the radius plus the one bit. Two values one bit apart so meet at
the home of either, and only homes are compared with visitors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from telltale.llm.components import components
from telltale.llm.tasks import chunks, column_bytes, only, others, place_of, ship, stored

BITS = 64
SEED = 42
# So many fingerprints of an anchor are compared in one task; more are cut into blocks.
BLOCK = 4096
# Runs of up to so many are compared without a loop over their rows.
SMALL = 16
# Fingerprints with more than one in so many of the rows are dealt over so many keys.
SALTS = 64


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The SimHash of one text: bit by bit what over half the shingle digests have."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
        starts = [0, *[e + 1 for e in ends[: len(words) - shingle]]]
        cuts = map(joined.__getitem__, map(slice, starts, ends[shingle - 1 :]))
        digests = map(xxhash.xxh64_intdigest, cuts, repeat(SEED))
    found = np.fromiter(digests, np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(found), 1 << 16):
        part = found[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(found), bitorder="little")
    return int(bits.view(np.uint64)[0])


def with_fingerprints(
    docs: DataFrame, shingle: int = 3, text: str = "text", into: str = "simhash"
) -> DataFrame:
    """Add the fingerprint of every whole text as a signed long.

    A NULL, empty or blank text has 0. Other columns are kept, one of the new
    name is replaced.
    """
    kept = others(docs.schema.fields, [into])
    names = [f.name for f in kept]
    schema = StructType([*kept, StructField(into, LongType(), False)])
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            found = [fingerprint(t, shingle) for t in column_bytes(batch, text)]
            signed = np.array(found, np.uint64).view(np.int64)
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(signed, pa.int64())], names=[*names, into]
            )

    return docs.mapInArrow(run, schema)


def parts_of(distance: int) -> list[tuple[int, int]]:
    """Shift and check bits of every part, such that some part differs in one bit at most."""
    if not 0 <= distance < BITS // 3:
        raise ValueError(f"distance {distance} is out of range")
    n = distance // 2 + 1
    width = BITS // n
    # 2^r - 1 bits of a part carry a Hamming code with r check bits.
    checks = (width + 1).bit_length() - 1
    return [(i * width, checks) for i in range(n)]


@lru_cache
def _columns(checks: int) -> tuple[np.ndarray, np.ndarray]:
    """Per bit of a code word its check number (1, 2, ...), and all corrections of two bits."""
    n = (1 << checks) - 1
    numbers = np.arange(1, n + 1, dtype=np.uint64)
    return numbers, np.uint64(1) << (numbers - np.uint64(1))


def _syndrome(values: np.ndarray, checks: int) -> np.ndarray:
    found = np.zeros(len(values), np.uint64)
    for bit in range((1 << checks) - 1):
        on = (values >> np.uint64(bit)) & np.uint64(1)
        found ^= on * np.uint64(bit + 1)
    return found


def anchors(values: np.ndarray, shift: int, checks: int) -> tuple[np.ndarray, np.ndarray]:
    """The home of every value, and all anchors within two bits, as two arrays.

    A value is on its home if its syndrome is 0; else one bit, the one whose
    number is the syndrome, leads there. Two bits lead to an anchor if their
    numbers give the syndrome together.
    """
    n = (1 << checks) - 1
    mask = np.uint64((1 << n) - 1)
    part = (values >> np.uint64(shift)) & mask
    syndrome = _syndrome(part, checks)
    flip = np.where(syndrome > 0, np.uint64(1) << (np.maximum(syndrome, 1) - np.uint64(1)), 0)
    home = part ^ flip.astype(np.uint64)
    numbers, bits = _columns(checks)
    # For every first bit the second is the one that completes the syndrome.
    other = numbers[None, :] ^ syndrome[:, None]
    pair = (other > numbers[None, :]) & (other > 0)
    second = np.where(pair, np.uint64(1) << (np.maximum(other, 1) - np.uint64(1)), 0).astype(np.uint64)
    visited = np.where(pair, part[:, None] ^ bits[None, :] ^ second, home[:, None])
    return home, visited


def _replicas(distinct: DataFrame, distance: int) -> DataFrame:
    """``(part, anchor, home, simhash)`` for every anchor that a fingerprint goes to."""
    schema = "part int, anchor long, home boolean, simhash long"
    parts = parts_of(distance)
    ship(distinct.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("simhash").to_numpy().view(np.uint64)
            for at in range(0, len(whole), 4096):
                values = whole[at : at + 4096]
                for k, (shift, checks) in enumerate(parts):
                    home, visited = anchors(values, shift, checks)
                    rows = np.repeat(np.arange(len(values)), visited.shape[1])
                    flat = visited.ravel()
                    away = flat != home[rows]
                    anchor = np.concatenate([home, flat[away]])
                    who = np.concatenate([values, values[rows[away]]])
                    is_home = np.arange(len(anchor)) < len(values)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(anchor), k, np.int32)),
                            pa.array(anchor.view(np.int64)),
                            pa.array(is_home),
                            pa.array(who.view(np.int64)),
                        ],
                        names=["part", "anchor", "home", "simhash"],
                    )

    return distinct.select("simhash").mapInArrow(run, schema)


def _forest(homes: np.ndarray, others: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what pairs of a home and another within the distance connect."""
    values = np.unique(np.concatenate([homes, others]))
    group = np.arange(len(values))
    at_home, at = np.searchsorted(values, homes), np.searchsorted(values, others)
    found = []
    for value, own in zip(homes, at_home):
        close = at[np.bitwise_count(others ^ value) <= distance]
        apart = close[group[close] != group[own]]
        while len(apart):
            other = apart[0]
            found.append((value, values[other]))
            low, high = sorted((group[own], group[other]))
            group[group == high] = low
            apart = apart[group[apart] != group[own]]
    return found


def _pairs(
    anchor: np.ndarray, home: np.ndarray, values: np.ndarray, distance: int
) -> Iterator[np.ndarray]:
    """Links inside runs of one anchor; homes come first in a run."""
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    run = np.repeat(np.arange(len(starts)), sizes)
    # Small runs are compared all at once, a row with the next, the one after, ...
    small = sizes[run] <= SMALL
    for step in range(1, SMALL):
        a = np.flatnonzero(small[:-step] & home[:-step] & (run[:-step] == run[step:]))
        if not len(a):
            break
        close = np.bitwise_count(values[a] ^ values[a + step]) <= distance
        yield np.stack([values[a[close]], values[a[close] + step]], axis=1)
    for k in np.flatnonzero(sizes > SMALL):
        part = slice(starts[k], starts[k] + sizes[k])
        found = _forest(values[part][home[part]], values[part], distance)
        yield np.array(found, np.uint64).reshape(-1, 2)


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """``(a, b)`` links between ``distinct(simhash)`` that connect all within the distance.

    An anchor with more than ``BLOCK`` fingerprints is cut into blocks, and each
    block of homes meets each block of all, so no task holds more than two
    blocks. Larger runs hand out a forest of links and not all pairs.
    """
    at = ["part", "anchor"]
    replicas = _replicas(distinct, distance)
    large = replicas.groupBy(*at).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    blocks = large.select(*at, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    sized = replicas.join(blocks, at, "left")
    own = F.pmod(F.xxhash64("simhash"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)

    def at_blocks(x: Column, y: Column, home: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"), home.alias("home"))

    whole = F.array(at_blocks(F.lit(0), F.lit(0), F.col("home")))
    meet = F.when(F.col("blocks").isNull(), whole)
    as_other = F.transform(every, lambda i: at_blocks(i, own, F.lit(False)))
    as_home = F.transform(every, lambda i: at_blocks(own, i, F.lit(True)))
    both = F.concat(as_other, F.when(F.col("home"), as_home).otherwise(F.slice(as_home, 1, 0)))
    dealt = sized.select(*at, "simhash", F.inline(F.coalesce(meet, both)))
    keys = [*at, "x", "y"]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys, F.col("home").desc(), "simhash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            key = _run_key(held)
            # The last run may go on in the next batch.
            cut = int(np.searchsorted(np.cumsum(key[::-1] != key[-1]), 1))
            done = held.num_rows - cut
            if done:
                yield from _found(held.slice(0, done), key[:done])
                held = held.slice(done)
        if held is not None:
            yield from _found(held, _run_key(held))

    def _found(table: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        home = table.column("home").to_numpy()
        values = table.column("simhash").to_numpy().view(np.uint64)
        for pairs in _pairs(key, home, values, distance):
            signed = pairs[pairs[:, 0] != pairs[:, 1]].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed[:, 0].copy()), pa.array(signed[:, 1].copy())], names=["a", "b"]
            )

    return ordered.mapInArrow(run, "a long, b long")


def _run_key(table: pa.Table) -> np.ndarray:
    """A number per run of equal keys."""
    columns = [table.column(n).to_numpy() for n in ("part", "anchor", "x", "y")]
    new = np.zeros(table.num_rows, bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def near_copies(prints: DataFrame, distance: int = 3) -> DataFrame:
    """``(simhash, component_id, root)`` for every fingerprint of ``prints(doc_id, simhash)``.

    ``component_id`` is the smallest ``doc_id`` reachable by links; documents
    without an id have none to give, and a component of only such documents has
    NULL. ``root`` names the component in any case. Equal fingerprints are
    merged before anything is compared. An empty table gives no rows.
    """
    distinct = stored(
        prints.groupBy("simhash").agg(F.min("doc_id").alias("first_id")), "simhash-distinct"
    )
    reached = components(links(distinct, distance)).withColumnRenamed("node", "simhash")
    reached = stored(reached, "simhash-roots")
    smallest = (
        reached.join(distinct, "simhash")
        .groupBy("root")
        .agg(F.min("first_id").alias("component_id"))
    )
    linked = reached.join(smallest, "root")
    return distinct.join(linked, "simhash", "left").select(
        "simhash",
        F.when(F.col("root").isNull(), F.col("first_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
        F.coalesce("root", "simhash").alias("root"),
    )


def as_hex(fingerprints: Column) -> Column:
    """Sixteen small hex digits."""
    return F.lower(F.lpad(F.hex(fingerprints), 16, "0"))


def components_of(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Reads ``doc_id`` and ``text`` only; repeated rows come out each.
    """
    prints = with_fingerprints(only(docs, "doc_id", "text"), shingle).drop("text")
    prints = stored(prints.withColumn("row", F.monotonically_increasing_id()), "simhash-prints")
    return _spread(prints, near_copies(prints, distance)).select(
        "doc_id", as_hex(F.col("simhash")).alias("fingerprint"), "component_id"
    )


def _spread(prints: DataFrame, copies: DataFrame) -> DataFrame:
    """Rows of ``prints(simhash, row)`` with the row of ``copies`` for their fingerprint.

    Fingerprints with more than one in ``SALTS`` of the rows, fewer than that many, are
    counted first; their rows are dealt over ``SALTS`` keys, each with a copy.
    """
    counts = prints.groupBy("simhash").agg(F.count("*").alias("n"))
    hot = counts.where(F.col("n") * SALTS > prints.count()).select("simhash").collect()
    is_hot = F.col("simhash").isin([r["simhash"] for r in hot])
    salt = F.when(is_hot, F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).otherwise(0)
    every = F.sequence(F.lit(0), F.when(is_hot, SALTS - 1).otherwise(0))
    right = copies.withColumn("salt", F.explode(every))
    return prints.withColumn("salt", salt).join(right, ["simhash", "salt"]).drop("salt")


def first_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """The documents with one row left of every component: the one with the smallest id.

    Rows without an id stay only where no other row of the component has one;
    of rows with one id the first of the table stays. All columns are kept.
    """
    # Columns go by number here, so none can clash with another.
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = (f"c{place_of(docs.columns, n)}" for n in ("doc_id", "text"))
    tagged = with_fingerprints(docs.toDF(*names), shingle, text, "simhash")
    tagged = stored(tagged.withColumn("row", F.monotonically_increasing_id()), "simhash-docs")
    prints = tagged.select(F.col(doc_id).alias("doc_id"), "simhash", "row")
    roots = near_copies(prints, distance).select("simhash", "root")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    best = _spread(prints, roots).groupBy("root").agg(F.min(order).alias("best"))
    chosen = best.select("best.row")
    return tagged.join(chosen, "row", "left_semi").select(*names).toDF(*docs.columns)
