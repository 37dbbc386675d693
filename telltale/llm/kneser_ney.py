"""A word bigram model with interpolated modified Kneser-Ney smoothing.

Counts are summed in Spark and stored as sorted arrays of digests, one file per
shard, in a folder that all machines mount; workers map the files into memory
to score texts. Tasks send sorted runs of digests and counts as binary, not a
row for each pair. A context whose pairs would fill a shard is dealt out by
pair; all others have their pairs in one shard.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from telltale.llm.tasks import chunks, mounted, only, others, ship, stored
from telltale.llm.word_digests import Words

# Words are known by the 64 bits of their digest; two numbers stand for the
# beginning and the end of a text.
BEGIN, END = 0x0B5E55ED, 0x00E17DED

# Distinct pairs or words that a task sums before it sends them on.
HELD = 3_000_000
# Bytes of text a shard, whose arrays one task holds, stands for.
SHARD_BYTES = 64 << 20
# A context is dealt out by pair from this share of a shard on.
LARGE = 0.25

_PART = "shard int, kind int, n long, raw binary"
_SUMS = ("n1", "n2", "n3", "n4")


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all tokens, and how many each text has: its words, then one end."""
    found = Words(texts, small=True)
    sizes = np.bincount(found.owner, minlength=found.n_texts) + 1
    words = np.full(int(sizes.sum()), END, np.uint64)
    # Every text before has added an end.
    words[np.arange(len(found.owner)) + found.owner] = found.digests
    return words, sizes


def contexts(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The token before every token, or the beginning."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum(sizes) - sizes] = BEGIN
    return before


def pair_digest(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (words + np.uint64(0x632BE59BD9B4E019))
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def word_shard(words: np.ndarray, shards: int) -> np.ndarray:
    return ((words * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(20)) % np.uint64(shards)


def pair_shard(before, words, large: np.ndarray, shards: int) -> np.ndarray:
    """By context, or by pair where the context is among the large ones."""
    spread = pair_digest(before, words) >> np.uint64(7)
    split = np.isin(before, large)
    return np.where(split, spread % np.uint64(shards), word_shard(before, shards))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _pack(*columns: np.ndarray) -> bytes:
    return b"".join(c.tobytes() for c in columns)


def _unpack(raw: bytes, n: int, kinds: tuple) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(raw, kind, n, at))
        at += size
    return out


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "kind", "n", "raw"]
    )


def _dealt(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows by shard, in their order."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.r_[True, shard[order][1:] != shard[order][:-1]]) if len(order) else []
    for rows in np.split(order, cuts[1:]) if len(order) else []:
        yield int(shard[rows[0]]), rows


def _word_parts(words: np.ndarray, counts: np.ndarray, shards: int, kind: int) -> list[tuple]:
    return [
        (shard, kind, len(rows), _pack(words[rows], counts[rows]))
        for shard, rows in _dealt(word_shard(words, shards))
    ]


# Kinds of parts.
_COUNTS, _BEFORE, _FOLLOW, _PAIRS = range(4)


def _held_tokens(batches, shards_of) -> Iterator[pa.RecordBatch]:
    """Sum what ``shards_of`` makes of chunks of tokens until a task holds much."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in chunks(batches, "text"):
        held.append(tokens(batch.column("text")))
        size += len(held[-1][0])
        if size >= HELD:
            yield _parts(shards_of(*map(np.concatenate, zip(*held))))
            held, size = [], 0
    if held:
        yield _parts(shards_of(*map(np.concatenate, zip(*held))))


class Model(NamedTuple):
    """Where the arrays are, and the numbers that belong to the whole."""

    folder: str
    shards: int
    large: np.ndarray
    n_tokens: int
    n_words: int
    n_texts: int
    n_pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    # The share of the word probabilities that the discounts left.
    spare: float


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The discounts for counts of one, two, and three or more, from counts of counts."""
    if not n1:
        return 0.0, 0.0, 0.0
    y = n1 / (n1 + 2 * n2)
    low = [1 - 2 * y * n2 / n1]
    low.append(2 - 3 * y * n3 / n2 if n2 else low[0])
    low.append(3 - 4 * y * n4 / n3 if n3 else low[1])
    return tuple(min(max(d, 0.0), k + 1.0) for k, d in enumerate(low))


def _count_classes(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5]


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Under its final name only when it is whole, so a repeated task does no harm."""
    half = os.path.join(folder, f".{name}-{os.getpid()}-{np.random.randint(1 << 30)}")
    with open(half, "wb") as file:
        np.save(file, array)
    os.rename(half, os.path.join(folder, f"{name}.npy"))


_STAT = "shard int, kind int, n long, raw binary, n1 long, n2 long, n3 long, n4 long"


def _stat_table(rows: list[tuple], sums) -> pa.Table:
    """Parts with counts of counts on the first of them."""
    table = pa.Table.from_batches([_parts(rows or [(0, -1, 0, b"")])])
    for name, value in zip(_SUMS, sums):
        column = np.zeros(table.num_rows, np.int64)
        column[0] = value
        table = table.append_column(name, pa.array(column))
    return table


def train(docs: DataFrame, folder: str, shards: int | None = None) -> Model:
    """Count ``docs(text)`` and write the model below ``folder``.

    Every text is its words in small A-Z and one end; a NULL or empty text is
    only the end. An empty table gives a model that knows no word.
    """
    spark = ship(docs.sparkSession)
    local = mounted(folder)
    os.makedirs(local, exist_ok=True)
    texts = only(docs, "text")
    if shards is None:
        size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))

    def words_of(words: np.ndarray, sizes: np.ndarray) -> list[tuple]:
        keys, counts = np.unique(words, return_counts=True)
        return _word_parts(keys, counts, shards, _COUNTS)

    def merge_words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = _merged(table, _COUNTS)
        # Words that may be large; few, as each has a share of this shard.
        top = counts * 64 >= max(1, counts.sum())
        rows = [(shard, _COUNTS, len(keys), _pack(keys, counts))]
        rows.append((shard, -2, int(top.sum()), _pack(keys[top], counts[top])))
        sums = (len(keys), int(counts.sum()), int(counts[keys == END].sum()), 0)
        return _stat_table(rows, sums)

    unigrams = stored(
        texts.mapInArrow(lambda b: _held_tokens(b, words_of), _PART)
        .groupBy("shard")
        .applyInArrow(merge_words, _STAT),
        "lm-words",
    )
    n_words, n_tokens, n_texts = _total(unigrams)[:3]
    tops = unigrams.where("kind = -2").collect()
    large = [_unpack(bytes(r["raw"]), r["n"], (np.uint64, np.int64)) for r in tops]
    limit = LARGE * n_tokens / shards
    keys = [k[c >= limit] for k, c in large]
    large_words = np.sort(np.concatenate([*keys, np.array([BEGIN], np.uint64)]))

    def pairs_of(words: np.ndarray, sizes: np.ndarray) -> list[tuple]:
        before = contexts(words, sizes)
        order = np.lexsort((words, before))
        before, words = before[order], words[order]
        new = np.r_[True, (before[1:] != before[:-1]) | (words[1:] != words[:-1])]
        first = np.flatnonzero(new)
        counts = np.diff(np.r_[first, len(words)])
        return [
            (shard, _PAIRS, len(rows), _pack_pairs(before[first[rows]], words[first[rows]], counts[rows]))
            for shard, rows in _dealt(pair_shard(before[first], words[first], large_words, shards))
        ]

    def merge_pairs(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        before, words, counts = _merged_pairs(table)
        _write_pairs(local, shard, before, words, counts)
        rows = _word_parts(*np.unique(words, return_counts=True), shards, _BEFORE)
        start = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        classes = (counts == 1, counts == 2, counts > 2)
        kinds = [np.add.reduceat(some.astype(np.int64), start) for some in classes]
        owner = before[start]
        for at, some in _dealt(word_shard(owner, shards)):
            rows.append((at, _FOLLOW, len(some), _pack(owner[some], *[k[some] for k in kinds])))
        return _stat_table(rows, _count_classes(counts))

    follow = stored(
        texts.mapInArrow(lambda b: _held_tokens(b, pairs_of), _PART)
        .groupBy("shard")
        .applyInArrow(merge_pairs, _STAT),
        "lm-pairs",
    )
    pair_sums = _total(follow)

    def write_words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = _merged(table, _COUNTS)
        with_before, before = _merged(table, _BEFORE)
        owners, sums = _merged_follow(table)
        every = np.unique(np.concatenate([keys, with_before, owners]))
        record = np.zeros((len(every), 6), np.uint64)
        record[:, 0] = every
        record[np.searchsorted(every, keys), 1] = counts
        record[np.searchsorted(every, with_before), 2] = before
        record[np.searchsorted(every, owners), 3:] = sums
        _save(local, f"words-{shard}", np.ascontiguousarray(record.T))
        return _stat_table([(shard, -3, int(before.sum()), b"")], _count_classes(before.astype(np.int64)))

    columns = ["shard", "kind", "n", "raw"]
    written = stored(
        unigrams.where(F.col("kind") == _COUNTS).select(*columns)
        .unionByName(follow.where("kind >= 0").select(*columns))
        .groupBy("shard")
        .applyInArrow(write_words, _STAT),
        "lm-written",
    )
    n_pairs = written.agg(F.sum("n")).first()[0] or 0
    classes = _total(written)
    off = discounts(*classes)
    once, twice = classes[:2]
    left = off[0] * once + off[1] * twice + off[2] * (n_words - once - twice)
    return Model(
        local,
        shards,
        large_words,
        n_tokens,
        n_words,
        n_texts,
        n_pairs,
        discounts(*pair_sums),
        off,
        left / n_pairs if n_pairs else 1.0,
    )


def _total(frame: DataFrame) -> tuple[int, ...]:
    return tuple(v or 0 for v in frame.agg(*[F.sum(n) for n in _SUMS]).first())


def _raws(table: pa.Table, kind: int) -> Iterator[tuple[bytes, int]]:
    columns = [table.column(c).to_pylist() for c in ("kind", "n", "raw")]
    return ((raw, n) for k, n, raw in zip(*columns) if k == kind)


def _merged(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    found = [_unpack(raw, n, (np.uint64, np.int64)) for raw, n in _raws(table, kind)]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return _summed(*map(np.concatenate, zip(*found)))


def _merged_follow(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    found = [_unpack(raw, n, (np.uint64, *[np.int64] * 3)) for raw, n in _raws(table, _FOLLOW)]
    if not found:
        return np.zeros(0, np.uint64), np.zeros((0, 3), np.int64)
    keys, *sums = map(np.concatenate, zip(*found))
    return _summed(keys, sums[0])[0], np.stack([_summed(keys, s)[1] for s in sums], axis=1)


def _pack_pairs(before: np.ndarray, words: np.ndarray, counts: np.ndarray) -> bytes:
    """Contexts once with the number of their words, then the words, counts in one byte or nine."""
    start = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
    many = np.diff(np.r_[start, len(before)]).astype(np.uint32)
    small = counts < 255
    rest = counts[~small].astype(np.int64)
    code = np.where(small, counts, 255).astype(np.uint8)
    head = np.array([len(start), len(words), len(rest)], np.int64)
    return _pack(head, before[start], many, words, code, rest)


def _unpack_pairs(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n_before, n, n_rest = (int(x) for x in np.frombuffer(raw, np.int64, 3))
    at = 24
    owners, at = np.frombuffer(raw, np.uint64, n_before, at), at + 8 * n_before
    many, at = np.frombuffer(raw, np.uint32, n_before, at), at + 4 * n_before
    words, at = np.frombuffer(raw, np.uint64, n, at), at + 8 * n
    counts, at = np.frombuffer(raw, np.uint8, n, at).astype(np.int64), at + n
    counts[counts == 255] = np.frombuffer(raw[at:], np.int64, n_rest)
    return np.repeat(owners, many), words, counts


def _merged_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = [_unpack_pairs(raw) for raw, _ in _raws(table, _PAIRS)]
    before, words, counts = map(np.concatenate, zip(*found))
    order = np.lexsort((words, before))
    before, words, counts = before[order], words[order], counts[order]
    first = np.flatnonzero(np.r_[True, (before[1:] != before[:-1]) | (words[1:] != words[:-1])])
    return before[first], words[first], np.add.reduceat(counts, first)


def _write_pairs(folder: str, shard: int, before, words, counts) -> None:
    """56 bits of the digest and 8 of the count in one sorted array; large counts beside it."""
    digest = pair_digest(before, words) >> np.uint64(8)
    code = np.minimum(counts, 255).astype(np.uint64)
    entry = (digest << np.uint64(8)) | code
    _save(folder, f"pairs-{shard}", np.sort(entry))
    over = counts >= 255
    order = np.argsort(digest[over])
    more = np.stack([digest[over][order], counts[over][order].astype(np.uint64)])
    _save(folder, f"large-{shard}", more)


class Scorer:
    """Looks words and pairs up in the mapped arrays of a model."""

    def __init__(self, model: Model):
        self._model, self._open = model, {}

    def _array(self, name: str) -> np.ndarray | None:
        if name not in self._open:
            path = os.path.join(self._model.folder, f"{name}.npy")
            self._open[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self._open[name]

    def _words(self, words: np.ndarray) -> np.ndarray:
        """Count, contexts before, and followers seen once, twice and more of every word."""
        found = np.zeros((5, len(words)), np.uint64)
        for shard, rows in _dealt(word_shard(words, self._model.shards)):
            table = self._array(f"words-{shard}")
            if table is not None and table.shape[1]:
                at = np.minimum(np.searchsorted(table[0], words[rows]), table.shape[1] - 1)
                found[:, rows] = np.where(table[0][at] == words[rows], table[1:, at], 0)
        return found.astype(np.float64)

    def _pairs(self, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        found = np.zeros(len(words), np.float64)
        digest = pair_digest(before, words) >> np.uint64(8)
        shard = pair_shard(before, words, self._model.large, self._model.shards)
        for at_shard, rows in _dealt(shard):
            table = self._array(f"pairs-{at_shard}")
            if table is None or not len(table):
                continue
            rows = rows[np.argsort(digest[rows])]
            at = np.minimum(np.searchsorted(table, digest[rows] << np.uint64(8)), len(table) - 1)
            entry = table[at]
            count = np.where(entry >> np.uint64(8) == digest[rows], entry & np.uint64(255), 0)
            large = np.flatnonzero(count == 255)
            count = count.astype(np.float64)
            if len(large):
                keys, counts = self._array(f"large-{at_shard}")
                count[large] = counts[np.searchsorted(keys, digest[rows[large]])]
            found[rows] = count
        return found

    def score(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, and the log10 probabilities of base and model of every text."""
        m = self._model
        flat, sizes = tokens(texts)
        words, word = np.unique(flat, return_inverse=True)
        before = contexts(flat, sizes)
        owners, owner = np.unique(before, return_inverse=True)
        order = np.lexsort((word, owner))
        new = np.r_[True, (word[order][1:] != word[order][:-1]) | (owner[order][1:] != owner[order][:-1])]
        pair = np.empty(len(flat), np.int64)
        pair[order] = np.cumsum(new) - 1
        first = order[new]
        counts, behind, *_ = self._words(words)
        known, _, f1, f2, f3 = self._words(owners)
        seen = np.where(owners == BEGIN, m.n_texts, known)
        n_pairs = self._pairs(before[first], flat[first])

        low = _kept(behind, m.word_discounts) / max(m.n_pairs, 1)
        # What the discounts left goes to every word and the unknown one alike.
        low = low + m.spare / (m.n_words + 1)
        d1, d2, d3 = m.pair_discounts
        weight = np.where(seen > 0, (d1 * f1 + d2 * f2 + d3 * f3) / np.maximum(seen, 1), 1.0)
        high = _kept(n_pairs, m.pair_discounts) / np.maximum(seen[owner[first]], 1)
        p = high + weight[owner[first]] * low[word[first]]
        starts = np.cumsum(sizes) - sizes
        base = np.log10((counts + 1) / (m.n_tokens + m.n_words + 1))[word]
        return (
            sizes,
            np.add.reduceat((counts > 0)[word].astype(np.int64), starts),
            np.add.reduceat(base, starts),
            np.add.reduceat(np.log10(p)[pair], starts),
        )


def score_texts(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``n_tokens, n_known, base_score, score`` of every whole text.

    ``score`` is the log10 probability of the text under the model,
    ``base_score`` that under counts of words with one added. A NULL text scores
    as an empty one, which is only its end. Other columns are kept, ones of these
    names replaced.
    """
    new = {"n_tokens": LongType(), "n_known": LongType(), "base_score": DoubleType(), "score": DoubleType()}
    kept = others(docs.schema.fields, new)
    names = [f.name for f in kept]
    schema = StructType([*kept, *[StructField(n, t, False) for n, t in new.items()]])
    # Numbers and the few words that are large; the arrays stay in their files.
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in chunks(batches, text):
            found = scorer.score(batch.column(text))
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, *map(pa.array, found)], names=[*names, *new]
            )

    return docs.mapInArrow(run, schema)


def _kept(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    off = np.where(counts > 2, d[2], np.where(counts > 1, d[1], np.where(counts > 0, d[0], 0)))
    return np.maximum(counts - off, 0)
