"""Passages of a benchmark in documents, up to a budget of edits.

Texts are compared in small A-Z with white space runs as one space. A passage of
L characters that occurs with e edits shares at least L + 1 - q (1 + e) of its
q-grams with the place, and they lie on diagonals (place in the text less place
in the passage) no more than e apart. So shared q-grams are counted in bands of
diagonals that overlap by half, bands that reach the bound are kept, and an
alignment inside the band decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telltale.llm.tasks import chunks, ship, stored

Q = 8
EDIT_RATE = 0.08
# Longer items are searched in passages of this length that overlap by half.
PASSAGE = 320
# Longer items are searched in excerpts of this length too, that overlap by half:
# any part of an item of one and a half times the length holds one whole.
EXCERPT = 120
# Items with fewer characters say nothing about where a text is from; they are
# found without edits, as whole words.
MIN_CHARS = 24
# Characters of the benchmark that are searched in one pass over the documents.
BLOCK_CHARS = 4_000_000
# Shared q-grams that are counted at once.
HITS = 1 << 20

_FOUND = "doc_id long, item_id long, passage int, start long, end long, edits int"
_BASE = 0x9E3779B97F4A7C15
_FAR = np.int32(1 << 20)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def normal(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small A-Z, runs of white space as one space; and where each character came from."""
    small = codes + np.uint32(32) * ((codes - np.uint32(65)) < 26)
    blank = (codes == 32) | ((codes - np.uint32(9)) < 5)
    small[blank] = 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    at = np.flatnonzero(keep)
    return small[at], at


def grams(codes: np.ndarray) -> np.ndarray:
    """A digest of every run of Q (a power of two) characters, by doubling."""
    found, width, factor = codes.astype(np.uint64) + np.uint64(1), 1, _BASE
    while width < Q:
        if len(found) <= width:
            return found[:0]
        found = found[:-width] * np.uint64(factor) + found[width:]
        factor = factor * factor % (1 << 64)
        width *= 2
    return found * np.uint64(0xD6E8FEB86659FD93)


class Pattern(NamedTuple):
    item: int
    passage: int
    codes: np.ndarray
    edits: int
    least: int
    excerpt: bool


class Index:
    """The q-grams of some benchmark items, and of their excerpts of a length if one is given.

    With ``short``, items of fewer than ``MIN_CHARS`` characters are searched too.
    """

    def __init__(
        self, items: list[tuple[int, str]], edit_rate: float, excerpt: int = 0, short: bool = False
    ):
        self.patterns: list[Pattern] = []
        # By length and digest, as digests of equal lengths only are compared.
        self.short: dict[int, dict[int, list[tuple[int, np.ndarray]]]] = {}
        for item, text in items:
            codes, _ = normal(_codes(text))
            codes = _trim(codes)
            if len(codes) < max(MIN_CHARS, Q):
                if short and len(codes):
                    *_, (size, digest) = _runs(codes, len(codes))
                    self.short.setdefault(size, {}).setdefault(int(digest[0]), []).append((item, codes))
                continue
            passages = _passages(codes, PASSAGE)
            excerpts = _passages(codes, excerpt) if 0 < excerpt < len(codes) else []
            for k, cut in enumerate([*passages, *excerpts]):
                size = len(cut)
                # No more edits than leave at least one q-gram untouched.
                edits = min(int(edit_rate * size), (size - Q) // Q)
                least = size + 1 - Q * (1 + edits)
                self.patterns.append(Pattern(item, k, cut, edits, least, k >= len(passages)))
        parts = [grams(p.codes) for p in self.patterns]
        sizes = [len(p) for p in parts]
        digest = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        order = np.argsort(digest, kind="stable")
        self.digest = digest[order]
        self.pattern = np.repeat(np.arange(len(parts)), sizes)[order]
        self.place = (np.concatenate([np.arange(n) for n in sizes]) if sizes else order)[order]
        # A table of flags says quickly that a q-gram is in no item.
        bits = min(26, max(16, (32 * max(1, len(digest))).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.flags = np.zeros(1 << bits, bool)
        self.flags[(self.digest >> self.shift).astype(np.int64)] = True
        self.edits = np.array([p.edits for p in self.patterns], np.int64)
        self.least = np.array([p.least for p in self.patterns], np.int64)

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int, int]]:
        """``(text, item, passage, start, end, edits)`` of every place found."""
        if not self.patterns and not self.short:
            return []
        whole = [_codes(t) for t in texts]
        ends = np.cumsum([len(w) for w in whole])
        codes, came = normal(np.concatenate(whole))
        found = self._short(codes, came, np.r_[0, ends]) if self.short else []
        if self.patterns:
            found += self._long(codes, came, ends)
        return sorted(found)

    def _short(self, codes, came, ends) -> list[tuple[int, int, int, int, int, int]]:
        rows = []
        for size, digest in _runs(codes, max(self.short)):
            wanted = self.short.get(size)
            if not wanted:
                continue
            for at in np.flatnonzero(np.isin(digest, np.array(list(wanted), np.uint64))):
                end = at + size
                t = int(np.searchsorted(ends, came[at], "right")) - 1
                low, high = np.searchsorted(came, ends[t : t + 2])
                if end > high or _inside_word(codes, at, low, high) or _inside_word(codes, end, low, high):
                    continue
                span = (int(came[at] - ends[t]), int(came[end - 1] + 1 - ends[t]))
                for item, own in wanted[int(digest[at])]:
                    if np.array_equal(own, codes[at:end]):
                        rows.append((t, item, 0, *span, 0))
        return _apart(sorted(rows))

    def _long(self, codes, came, ends) -> list[tuple[int, int, int, int, int, int]]:
        digest = grams(codes)
        at = np.flatnonzero(self.flags[(digest >> self.shift).astype(np.int64)])
        low = np.searchsorted(self.digest, digest[at], "left")
        many = np.searchsorted(self.digest, digest[at], "right") - low
        text = np.searchsorted(ends, came[at], "right")
        many[text != np.searchsorted(ends, came[at + Q - 1], "right")] = 0
        regions = self._regions(at, low, many, text, len(codes))
        bounds = np.searchsorted(came, np.r_[0, ends])
        return self._verified(codes, came, np.r_[0, ends], bounds, *regions)

    def _regions(self, at, low, many, text, size) -> tuple[np.ndarray, ...]:
        """Bands with enough shared q-grams: text, pattern, first diagonal of the band.

        A place with a q-gram of ``many`` entries from ``low`` on is that many hits. They
        are counted in lots, as a text of one character hits each entry of such an item
        at every place, in few bands.
        """
        stride = np.maximum(self.edits, 1)
        total = np.append(0, np.cumsum(many))
        counted, start = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        while start < len(at):
            end = max(start + 1, int(np.searchsorted(total, total[start] + HITS, "right")) - 1)
            lot = slice(start, end)
            hit = np.repeat(np.arange(start, end), many[lot])
            first = np.repeat(low[lot] - total[lot] + total[start], many[lot])
            entry = first + np.arange(len(hit))
            pattern = self.pattern[entry]
            # The text's own length keeps band numbers above zero.
            band = (at[hit] - self.place[entry] + size) // stride[pattern] + 1
            key = (text[hit].astype(np.int64) * len(self.patterns) + pattern) << np.int64(32)
            # Band b holds strides b and b + 1, so a hit belongs to two bands.
            both = np.concatenate([key + band, key + band - 1])
            counted.append(np.unique(both, return_counts=True))
            if len(counted) > 16:
                counted = [_added(counted)]
            start = end
        keys, counts = _added(counted)
        who = (keys >> np.int64(32)) % len(self.patterns)
        keep = counts >= self.least[who]
        keys, who = keys[keep], who[keep]
        first = ((keys & np.int64(0xFFFFFFFF)) - 1) * stride[who] - size
        return (keys >> np.int64(32)) // len(self.patterns), who, first

    def _verified(self, codes, came, ends, bounds, text, pattern, first) -> list[tuple]:
        found: dict[tuple, tuple] = {}
        parts: set[tuple] = set()
        for a in range(0, len(text), 256):
            part = slice(a, a + 256)
            who = [self.patterns[p] for p in pattern[part]]
            starts = first[part] - [p.edits for p in who]
            widths = [2 * max(p.edits, 1) + 2 * p.edits + 1 for p in who]
            low, high = bounds[text[part]], bounds[text[part] + 1]
            cost, last = align([p.codes for p in who], codes, starts, widths, low, high, True)
            ok = np.flatnonzero(cost <= [p.edits for p in who])
            if not len(ok):
                continue
            # Backwards from the end that was found, to the beginning.
            turned = codes[::-1]
            n = len(codes)
            back, begin = align(
                [who[i].codes[::-1] for i in ok],
                turned,
                np.array([n - last[i] - who[i].edits for i in ok]),
                [2 * who[i].edits + 1 for i in ok],
                n - high[ok],
                n - low[ok],
                False,
            )
            for j, i in enumerate(ok):
                t, p = int(text[part][i]), who[i]
                start, end = int(n - begin[j]), int(last[i])
                base = int(ends[t])
                span = (int(came[start]) - base, int(came[end - 1]) + 1 - base)
                key = (t, p.item, p.passage, end)
                row = (t, p.item, p.passage, *span, int(cost[i]))
                found[key] = min(found.get(key, row), row, key=lambda r: r[5])
                if p.excerpt:
                    parts.add(key)
        wholes = _apart(sorted(found[k] for k in found.keys() - parts))
        return sorted([*wholes, *_elsewhere(_apart(sorted(found[k] for k in parts)), wholes)])


def _added(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by key, from several lists of keys that differ within each."""
    if len(counted) <= 2:
        return counted[-1]
    keys, at = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in counted]), len(keys)).astype(np.int64)


def _trim(codes: np.ndarray) -> np.ndarray:
    seen = np.flatnonzero(codes != 32)
    return codes[seen[0] : seen[-1] + 1] if len(seen) else codes[:0]


def _runs(codes: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """Digests of all runs of 1, 2, and up to so many characters."""
    found = digest = codes.astype(np.uint64) + np.uint64(1)
    for size in range(1, min(most, len(codes)) + 1):
        if size > 1:
            digest = digest[:-1] * np.uint64(_BASE) + found[size - 1 :]
        yield size, digest


def _inside_word(codes, at, low, high) -> bool:
    """Whether letters or digits of one text stand on both sides of a place."""
    return low < at < high and chr(codes[at - 1]).isalnum() and chr(codes[at]).isalnum()


def _passages(codes: np.ndarray, size: int) -> list[np.ndarray]:
    if len(codes) <= size:
        return [codes]
    starts = [*range(0, len(codes) - size, size // 2), len(codes) - size]
    return [codes[s : s + size] for s in starts]


def _elsewhere(parts: list[tuple], wholes: list[tuple]) -> list[tuple]:
    """Excerpts that overlap no whole passage of their item in the text."""
    taken: dict[tuple, list] = {}
    for row in wholes:
        taken.setdefault(row[:2], []).append(row[3:5])
    return [
        r for r in parts if not any(r[3] < end and start < r[4] for start, end in taken.get(r[:2], ()))
    ]


def _apart(rows: list[tuple]) -> list[tuple]:
    """Of overlapping places of one passage the one with the fewest edits."""
    out: list[tuple] = []
    for row in rows:
        before = out[-1] if out else None
        if before and before[:3] == row[:3] and row[3] < before[4]:
            if row[5] < before[5]:
                out[-1] = row
        else:
            out.append(row)
    return out


def align(patterns, codes, starts, widths, low, high, free: bool) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of every pattern against the text from its band on, and where it ends.

    Column k of row i stands for text up to ``start + i + k``. With ``free`` the
    place may begin anywhere in the band, else at its middle. Text outside
    ``low`` to ``high`` matches nothing. All pairs go through the rows together.
    """
    n, width = len(patterns), max(widths)
    rows = max(len(p) for p in patterns)
    wanted = np.zeros((rows, n), np.int64)
    for c, p in enumerate(patterns):
        wanted[: len(p), c] = p
    sizes = np.array([len(p) for p in patterns])
    starts, widths = np.asarray(starts, np.int64), np.asarray(widths)
    k = np.arange(width, dtype=np.int32)
    beyond = k[None, :] >= widths[:, None]
    if free:
        cost = np.where(beyond, _FAR, np.int32(0))
    else:
        middle = (widths // 2)[:, None]
        cost = np.where(beyond | (k < middle), _FAR, k - middle).astype(np.int32)
    # An end before the text begins, or after it ends, is no end.
    cost = np.where(_outside(starts, 0, k, low, high), _FAR, cost).astype(np.int32)
    final = cost.copy()
    for i in range(rows):
        place = starts[:, None] + i + k[None, :]
        inside = (place >= low[:, None]) & (place < high[:, None])
        got = codes[np.clip(place, 0, len(codes) - 1)]
        step = cost + np.where(inside & (got == wanted[i][:, None]), 0, 1).astype(np.int32)
        step = np.where(inside, step, _FAR)
        skipped = np.concatenate([cost[:, 1:], np.full((n, 1), _FAR, np.int32)], axis=1) + 1
        best = np.where(beyond, _FAR, np.minimum(step, skipped))
        best = np.where(_outside(starts, i + 1, k, low, high), _FAR, best)
        cost = (np.minimum.accumulate(best - k, axis=1) + k).astype(np.int32)
        cost = np.where(beyond, _FAR, np.minimum(cost, _FAR))
        done = sizes == i + 1
        final[done] = cost[done]
    end = final.argmin(axis=1)
    return final[np.arange(n), end], starts + sizes + end


def _outside(starts, i, k, low, high) -> np.ndarray:
    place = starts[:, None] + i + k[None, :]
    return (place < low[:, None]) | (place > high[:, None])


_indexes: dict = {}


def find_passages(
    docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE, short: bool = True
) -> DataFrame:
    """Every place where a document holds a passage of ``benchmark(item_id, text)``.

    One row per place: ``doc_id, item_id, passage, start, end, edits``, with
    offsets into the text as it is. Of overlapping places of one passage that
    with the fewest edits is given. A part of an item is found through excerpts
    of ``EXCERPT`` characters; they have the numbers after its passages and are
    given where no whole passage of the item lies. Repeated items count once; items
    without an id are reported with a NULL one. Items of under ``MIN_CHARS``
    characters are found as they are, between word borders, or with ``short``
    false not at all. NULL and blank items are not searched, a NULL text holds
    nothing. Documents are never shuffled. The benchmark is a set of queries: it
    is searched in blocks of ``BLOCK_CHARS`` characters, one pass over the
    documents each, and only one block is on the driver and the workers at once.
    """
    spark = ship(docs.sparkSession)
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long"), "text").distinct()
    total = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))
    found = []
    for block in range(blocks):
        mine = items
        if blocks > 1:
            mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        taken = [tuple(r) for r in mine.collect()]
        rows = sorted(r for r in taken if r[0] is not None)
        # Numbers after all ids stand for the items without one.
        unnamed = rows[-1][0] + 1 if rows else 0
        rows += [(unnamed + k, t) for k, t in enumerate(sorted(t for i, t in taken if i is None))]
        shared = spark.sparkContext.broadcast((unnamed, (rows, edit_rate, EXCERPT, short)))
        frame = _search(docs, shared)
        found.append(frame if blocks == 1 else stored(frame, "passages"))
    whole = found[0]
    for frame in found[1:]:
        whole = whole.unionByName(frame)
    return whole


def _search(docs: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value is not _indexes.get("of"):
            _indexes["of"], _indexes["index"] = shared.value, Index(*shared.value[1])
        unnamed = shared.value[0]
        for batch in chunks(batches, "text", 512 << 10):
            ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = [
                (ids[t], item if item < unnamed else None, *rest)
                for t, item, *rest in _indexes["index"].search(texts)
            ]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    names=["doc_id", "item_id", "passage", "start", "end", "edits"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _FOUND)


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE
) -> DataFrame:
    """The documents that hold no passage of the benchmark, with all their columns.

    Rows are judged by their own text, so rows that share an id, or have none,
    do not answer for each other. Items of under ``MIN_CHARS`` characters, which
    any text may hold, drop none.
    """
    row = "__passage_row"
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "passage-docs")
    by_row = numbered.select(F.col(row).alias("doc_id"), "text")
    hit = stored(find_passages(by_row, benchmark, edit_rate, short=False).select("doc_id").distinct(), "passage-hits")
    bad = hit.select(F.col("doc_id").alias(row))
    return numbered.join(bad, row, "left_anti").select(*docs.columns)
