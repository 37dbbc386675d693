"""Repeated passages, found with FM-indexes over shards of the corpus.

A window of W words repeats only if its words meet again. In every window the
run of M words with the smallest digest is its anchor; equal windows have equal
anchors. Windows in a row with one anchor form a segment, and only segments
whose anchor occurs again in the corpus can hold a repeated window. They go to
shards by their anchor, so equal windows meet in one shard. There an FM-index is
built over the segments in the order of the corpus, the segments are streamed
backwards through it, and every window found at an earlier place is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from telltale.llm.tasks import WORD_BREAK_PATTERN, chunks, only, others, place_of, ship, stored
from telltale.llm.word_digests import Words, run_digests

WINDOW = 20
ANCHOR = 5
# Words of a shard, and segments of one anchor beyond which its windows are dealt out.
SHARD_WORDS = 1 << 18
ANCHOR_SEGMENTS = 2000
# Bits of a sieve, at most.
SIEVE_BITS = 1 << 27


def _mixed(words: np.ndarray, size: int) -> np.ndarray:
    """A digest of every run of so many words; run i begins at word i."""
    n = len(words) - size + 1
    found = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        found = (found ^ words[k : k + len(found)]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return found


def _smallest(digest: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest digest of every ``width`` in a row is, the first of equals."""
    best, at, reach = digest, np.arange(len(digest)), 1
    while 2 * reach <= width:
        best, at = _less(best, at, reach)
        reach *= 2
    if reach < width:
        best, at = _less(best, at, width - reach)
    return at


def _less(best: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = slice(0, len(best) - step), slice(step, None)
    later = best[right] < best[left]
    return np.where(later, best[right], best[left]), np.where(later, at[right], at[left])


def segments(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """``(text, first word, windows, anchor, digest)`` of every segment of some texts.

    The first word is numbered through all texts; ``digest`` is that of all words
    of a segment.
    """
    size = min(ANCHOR, window)
    runs = _mixed(words.digests, size)
    n = max(0, len(words.digests) - window + 1)
    at = _smallest(runs, window - size + 1) if n else np.zeros(0, np.int64)
    start = np.flatnonzero(words.owner[:n] == words.owner[window - 1 : window - 1 + n])
    at, owner = at[start], words.owner[start]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    many = np.diff(np.r_[first, len(start)])
    begin = start[first]
    digest = run_digests(words.digests, begin, begin + many + window - 1)
    return owner[first], begin, many, runs[at[first]], digest


def place_keys(doc_id: np.ndarray, tie: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A small digest of where a segment is."""
    mixed = doc_id.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ tie.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ first.astype(np.uint64)) * np.uint64(0xD1B54A32D192ED03)
    return (mixed >> np.uint64(33)).astype(np.int64)


def _named(docs: DataFrame) -> DataFrame:
    """A document is its id and its text; rows that share both are the same document."""
    docs = only(docs, "doc_id", "text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tie(F.col("text")), "text")


def _tie(text: Column) -> Column:
    """What tells texts of one id, or of none, apart: 64 bits."""
    return F.xxhash64(text).alias("tie")


def sieve(keys: DataFrame) -> np.ndarray | None:
    """A bit for the low end of every key of ``keys(key long)``, as 64-bit words.

    It only saves work: what passes by chance is sorted out later. Its size is
    bounded, so beyond some number of keys more and more passes. No keys: None.
    """
    n = keys.count()
    if not n:
        return None
    bits = min(SIEVE_BITS, 1 << max(10, (16 * n - 1).bit_length()))
    slot = F.col("key").bitwiseAND(F.lit(bits - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    words = (
        keys.select(F.call_function("shiftright", slot, F.lit(6)).alias("at"), one.alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("word"))
        .toArrow()
    )
    found = np.zeros(bits // 64, np.uint64)
    found[words.column("at").to_numpy()] = words.column("word").to_numpy().view(np.uint64)
    return found


def passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64(64 * len(words) - 1)
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


_FOUND = "doc_id long, tie long, first int, many int, anchor long, digest long, spot long"


def _cut(batches, window: int) -> Iterator[tuple]:
    """Chunks of documents, their words, and their segments with the place of each."""
    for batch in chunks(batches, "text", 2 << 20):
        words = Words(batch.column("text"))
        owner, begin, many, anchor, digest = segments(words, window)
        # Words of the texts before, to number the words of each text from 0.
        before = np.searchsorted(words.owner, np.arange(words.n_texts))
        first = (begin - before[owner]).astype(np.int32)
        ids = batch.column("doc_id").fill_null(-1).to_numpy()
        ties = batch.column("tie").to_numpy()
        spot = place_keys(ids[owner], ties[owner], first)
        yield batch, words, owner, begin, first, many.astype(np.int32), anchor, digest, spot


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """The anchor of every segment."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, anchor, _, _ in _cut(batches, window):
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64))], names=["key"])

    return docs.mapInArrow(run, "key long")


def _segments(docs: DataFrame, window: int, again: np.ndarray) -> DataFrame:
    """Segments whose anchor passes the sieve, without their words."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(again)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, owner, _, first, many, anchor, digest, spot in _cut(batches, window):
            keep = np.flatnonzero(passes(shared.value, anchor))
            at = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("tie").take(at),
                    pa.array(first[keep]),
                    pa.array(many[keep]),
                    pa.array(anchor[keep].view(np.int64)),
                    pa.array(digest[keep].view(np.int64)),
                    pa.array(spot[keep]),
                ],
                names=["doc_id", "tie", "first", "many", "anchor", "digest", "spot"],
            )

    return docs.mapInArrow(run, _FOUND)


def _contents(docs: DataFrame, window: int, wanted: np.ndarray) -> DataFrame:
    """Segments whose place passes the sieve, with their words joined by one space."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, owner, begin, first, many, _, _, spot in _cut(batches, window):
            keep = np.flatnonzero(passes(shared.value, spot.view(np.uint64)))
            at = pa.array(owner[keep])
            ends = (begin + many + window - 1)[keep].tolist()
            texts = list(map(words.joined, begin[keep].tolist(), ends))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("tie").take(at),
                    pa.array(first[keep]),
                    pa.array(texts, pa.binary()),
                ],
                names=["doc_id", "tie", "first", "words"],
            )

    return docs.mapInArrow(run, "doc_id long, tie long, first int, words binary")


class WaveletMatrix:
    """How often a symbol occurs before a place, from one packed row of bits per binary digit."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self._digits = max(1, int(n_symbols - 1).bit_length())
        self._rows, self._zeros = [], []
        for digit in range(self._digits - 1, -1, -1):
            on = ((symbols >> digit) & 1).astype(bool)
            padded = np.zeros(-(-(len(on) + 1) // 64) * 64, bool)
            padded[: len(on)] = on
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.zeros(len(packed), np.uint32)
            np.cumsum(np.bitwise_count(packed)[:-1], out=before[1:])
            self._rows.append((packed, before))
            self._zeros.append(len(on) - int(on.sum()))
            symbols = np.concatenate([symbols[~on], symbols[on]])
        self._base = self._walk(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _walk(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level, (packed, before) in enumerate(self._rows):
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            below = packed[word] & ((np.uint64(1) << bit) - np.uint64(1))
            ones = before[word] + np.bitwise_count(below).astype(np.int64)
            on = (symbol >> (self._digits - 1 - level)) & 1
            place = np.where(on == 1, self._zeros[level] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._walk(symbol, place) - self._base[symbol]


class FmIndex:
    """Backward search in a text of symbols, for patterns of up to ``longest`` without 0.

    The text ends in symbol 0.
    """

    def __init__(self, text: np.ndarray, n_symbols: int, longest: int):
        rank, step = text.astype(np.int64), 1
        self.places = np.argsort(rank, kind="stable")
        # Suffixes are sorted by twice as many symbols in every round.
        while True:
            pair = rank * (len(text) + n_symbols + 1)
            pair[:-step] += rank[step:] + 1
            self.places = np.argsort(pair, kind="stable")
            ordered = pair[self.places]
            new = np.r_[False, ordered[1:] != ordered[:-1]]
            rank = np.empty(len(text), np.int64)
            rank[self.places] = np.cumsum(new)
            step *= 2
            if step >= longest or step >= len(text) or new.sum() == len(text) - 1:
                break
        self._last = WaveletMatrix(text[self.places - 1], n_symbols)
        self._starts = np.r_[0, np.cumsum(np.bincount(text, minlength=n_symbols))]
        self._n = len(text)

    def whole(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(n, np.int64), np.full(n, self._n, np.int64)

    def extend(self, symbol, low, high) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of patterns with one more symbol in front."""
        start = self._starts[symbol]
        return start + self._last.rank(symbol, low), start + self._last.rank(symbol, high)

    def earliest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first place in the text of every interval, none of which is empty."""
        pairs, back = np.unique(np.stack([low, high], axis=1), axis=0, return_inverse=True)
        padded = np.r_[self.places, 0]
        return np.minimum.reduceat(padded, pairs.ravel())[::2][back.ravel()]


def repeated_windows(contents: list[bytes], window: int) -> list[np.ndarray]:
    """For every segment the windows that also begin at an earlier place.

    The segments are in the order of the corpus. Window after window is searched
    from its last word to its first; one that is left alone drops out at once.
    """
    known: dict[bytes, int] = {}
    lists = [[known.setdefault(w, len(known) + 1) for w in c.split()] for c in contents]
    sizes = np.array([len(x) + 1 for x in lists], np.int64)
    ends = np.cumsum(sizes)
    # Symbol 0 stands between segments.
    text = np.zeros(int(ends[-1]), np.int64)
    for words, end in zip(lists, ends):
        text[end - 1 - len(words) : end - 1] = words
    index = FmIndex(text, len(known) + 1, window)
    owner = np.repeat(np.arange(len(lists)), np.maximum(sizes - window, 0))
    begins = ends - sizes
    first = np.concatenate([np.arange(b, e - window) for b, e in zip(begins, ends)])
    at, (low, high) = np.arange(len(first)), index.whole(len(first))
    for k in range(window - 1, -1, -1):
        low, high = index.extend(text[first[at] + k], low, high)
        more = high - low > 1
        at, low, high = at[more], low[more], high[more]
    if len(at):
        at = at[index.earliest(low, high) < first[at]]
    found = first[at] - begins[owner[at]]
    cuts = np.searchsorted(owner[at], np.arange(len(lists) + 1))
    return [found[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


_DOC = "doc_id long, tie long"
_SPAN = f"{_DOC}, start int, end int"
_SPANS = "array<struct<start: int, end: int, kind: int>>"


def _search(distinct: DataFrame, window: int) -> DataFrame:
    """Repeated windows of distinct segments, shard by shard, as spans of words."""
    width = F.sum((F.col("many") + window).cast("long"))
    words = distinct.agg(width).first()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    ship(distinct.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        place = table.column("place").combine_chunks().flatten()
        nameless, doc, tie, first = place
        order = pc.sort_indices(
            pa.table({"n": nameless, "d": doc, "t": tie, "f": first}),
            sort_keys=[(c, "ascending") for c in "ndtf"],
        )
        contents = table.column("words").take(order).to_pylist()
        found = repeated_windows(contents, window)
        n = pa.array(np.repeat(order.to_numpy(), [len(f) for f in found]))
        offset = np.concatenate(found) if found else np.zeros(0, np.int64)
        start = first.take(n).to_numpy() + offset
        return pa.table(
            {
                "doc_id": doc.take(n),
                "tie": tie.take(n),
                "start": pa.array(start, pa.int32()),
                "end": pa.array(start + window, pa.int32()),
            }
        )

    return dealt.select("shard", "place", "words").groupBy("shard").applyInArrow(run, _SPAN)



def _place() -> Column:
    """Places in the order of the corpus; documents without an id come last."""
    return F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "tie", "first")


# What a span says: all of it is repeated, it is the first place of its words
# after all, or it is repeated for sure.
_LATER, _FIRST, _SURE = range(3)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, tie, spans)``: words under windows that also start earlier.

    Three passes over the texts, none of which shuffles them: anchors are
    counted; segments with an anchor that occurs again are noted by digest; and
    the words of those are read that have to be searched. Equal segments are
    merged by anchor and digest with the first place of each, all their other
    places are repeated as a whole. Of an anchor with one segment nothing is left
    to search. The segments of the others go to the shards; an anchor with more
    than ``ANCHOR_SEGMENTS`` would fill one, so its windows are dealt out singly
    and merged by their words.
    """
    named = _named(docs)
    again = _anchors(named, window).groupBy("key").agg(F.count("*").alias("n"))
    again = sieve(stored(again.where("n > 1").select("key"), "anchors"))
    if again is None:
        return docs.sparkSession.createDataFrame([], f"{_DOC}, spans {_SPANS}")
    found = stored(_segments(named, window, again), "segments")
    place = F.struct(_place().alias("at"), "spot", "many")
    firsts = stored(
        found.groupBy("anchor", "digest").agg(F.min(place).alias("p")).select(
            "anchor", "p.at.doc_id", "p.at.tie", "p.at.first", "p.spot", "p.many"
        ),
        "segments-first",
    )
    several = firsts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    wanted = stored(firsts.join(several, "anchor"), "segments-wanted")
    spans = [
        _span(found, F.col("many") + window - 1, _LATER),
        _span(firsts, F.col("many") + window - 1, _FIRST),
    ]
    spots = sieve(wanted.select(F.col("spot").alias("key")))
    if spots is not None:
        right = wanted.drop("spot").withColumnsRenamed(
            {"doc_id": "__id", "tie": "__tie", "first": "__first"}
        )
        same = F.expr("doc_id <=> __id AND tie = __tie AND first = __first")
        read = _contents(named, window, spots).join(right, same).select(
            _place().alias("place"), "anchor", "n", "many", "words"
        )
        # Rows that are the same document bring a segment each.
        read = read.groupBy("place").agg(
            *[F.first(c).alias(c) for c in ("anchor", "n", "many", "words")]
        )
        read = stored(read, "segments-read")
        crowded = F.col("n") > ANCHOR_SEGMENTS
        spans += _crowded(read.where(crowded), window)
        spans.append(_search(read.where(~crowded), window).withColumn("kind", F.lit(_SURE)))
    whole = spans[0]
    for more in spans[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("doc_id", "tie").agg(
        F.collect_list(F.struct("start", "end", "kind")).alias("spans")
    )


def _span(rows: DataFrame, width: Column, kind: int) -> DataFrame:
    return rows.select(
        "doc_id",
        "tie",
        F.col("first").alias("start"),
        (F.col("first") + width).alias("end"),
        F.lit(kind).alias("kind"),
    )


def _crowded(read: DataFrame, window: int) -> list[DataFrame]:
    """Spans of single windows, merged by their words."""
    single = read.select("place", F.posexplode(_windows(window)).alias("offset", "words")).select(
        "place.doc_id",
        "place.tie",
        (F.col("place.first") + F.col("offset")).alias("first"),
        F.md5("words").alias("key"),
    )
    firsts = single.groupBy("key").agg(F.min(_place()).alias("p"))
    at = firsts.select(
        F.col("p.doc_id").alias("__id"), F.col("p.tie").alias("__tie"), F.col("p.first").alias("__first")
    )
    same = F.expr("doc_id <=> __id AND tie = __tie AND first = __first")
    return [_span(single.join(at, same, "left_anti"), F.lit(window), _SURE)]


def _windows(window: int) -> Column:
    """The windows of a segment, each as its words joined by one space."""
    words = F.split(F.col("words").cast("string"), " ")
    one = F.transform(
        F.sequence(F.lit(1), F.col("many")), lambda i: F.concat_ws(" ", F.slice(words, i, window))
    )
    return F.transform(one, lambda x: x.cast("binary"))


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Take the words out of every text that lie in a window which also starts earlier.

    A window is ``window`` words in a row; earlier means in a document with a
    smaller id, or further up in the same one. Documents with one id are ordered
    by the digest of their text, those without an id come last. Windows are
    judged on the texts as they come in. A text that loses words is left as its
    other words joined by one space; any other text stays as it is. A NULL text
    has no words. Adds ``n_words`` (before) and ``n_removed``; other columns are
    kept, ones of these names, in any case, replaced.
    """
    lists = repeated_spans(docs, window)
    new = ("n_words", "n_removed")
    kept = others(docs.schema.fields, new)
    # Columns go by number here, so none can clash with another.
    numbers = [f"c{i}" for i in range(len(docs.columns))]
    own_id, own_text = (f"c{place_of(docs.columns, n)}" for n in ("doc_id", "text"))
    names = [numbers[i] for i, f in enumerate(docs.schema.fields) if f in kept]
    tagged = docs.toDF(*numbers).select(
        *names, F.col(own_id).cast("long").alias("own_id"), _tie(F.col(own_text)).alias("own_tie")
    )
    tagged = _packed(tagged, own_text)
    same = tagged["own_id"].eqNullSafe(lists["doc_id"]) & (tagged["own_tie"] == lists["tie"])
    joined = tagged.join(lists, same, "left").select(*names, "spans")
    schema = StructType([*kept, *[StructField(n, LongType(), False) for n in new]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in chunks(batches, own_text, 2 << 20):
            texts, totals, gone = [], [], []
            for raw, spans in zip(batch.column(own_text).to_pylist(), batch.column("spans").to_pylist()):
                text = None if raw is None else unpack.decompress(raw)
                words = (text or b"").split()
                out = _covered(len(words), spans or ())
                totals.append(len(words))
                gone.append(int(out.sum()))
                if gone[-1]:
                    text = b" ".join([words[k] for k in np.flatnonzero(~out)])
                texts.append(text)
            columns = [
                pa.array(texts, pa.binary()).cast(pa.string()) if n == own_text else batch.column(n)
                for n in names
            ]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(totals, pa.int64()), pa.array(gone, pa.int64())],
                names=schema.names,
            )

    return joined.mapInArrow(run, schema)


def _covered(n: int, spans) -> np.ndarray:
    """Which of n words lie in a span, once those of first places are taken out."""
    first = {s["start"] for s in spans if s["kind"] == _FIRST}
    cover = np.zeros(n + 1, np.int64)
    for s in spans:
        if s["kind"] == _SURE or s["kind"] == _LATER and s["start"] not in first:
            cover[s["start"]] += 1
            cover[s["end"]] -= 1
    return np.cumsum(cover[:-1]) > 0


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """Texts compressed, as they are shuffled once to meet their spans."""
    fields = [StructField(text, BinaryType()) if f.name == text else f for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in chunks(batches, text):
            raw = batch.column(text).cast(pa.binary()).to_pylist()
            packed = pa.array([None if t is None else pack.compress(t) for t in raw], pa.binary())
            columns = [packed if n == text else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, StructType(fields))


def plain_words(text: str = "text") -> Column:
    """The words of a text joined by one space."""
    pieces = F.split(F.coalesce(F.col(text), F.lit("")), WORD_BREAK_PATTERN)
    return F.array_join(F.array_remove(pieces, ""), " ")
