"""Quality from compression: which of two dictionaries makes a text smaller.

One zstandard dictionary is built from good labelled text, one from bad. A text
is compressed with either, in blocks, so that the dictionary counts through the
whole of a long text. The difference of the sizes per byte becomes a score by
an isotonic curve fitted on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from telltale.llm.tasks import chunks, column_bytes, others, ship

LEVEL = 3
BLOCK = 2048
DICTIONARY_BYTES = 65536
# The model is fitted on at most so many labelled documents of a class, and at
# most so many bytes of each.
SAMPLE_DOCS = 2000
SAMPLE_BYTES = 32768
# A text counts as so many bytes of typical good text more than it has, so short
# texts say little.
PRIOR_BYTES = 64


class QualityModel(NamedTuple):
    """Two dictionaries, the typical difference of good text and the curve of scores."""

    good: bytes
    bad: bytes
    typical: float
    at: list[float]
    score: list[float]


class Differ:
    """Sizes under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes, typical: float = 0.0):
        self._typical = typical
        self._sides = []
        for raw in (bad, good):
            # A dictionary that could not be trained is the text itself.
            known = zstandard.ZstdCompressionDict(raw)
            known.precompute_compress(level=LEVEL)
            self._sides.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False
                )
            )

    def raw(self, text: bytes) -> tuple[int, int]:
        """Bytes that the good dictionary saves, and the bytes of the text."""
        bad, good = (
            sum(len(side.compress(text[i : i + BLOCK])) for i in range(0, len(text), BLOCK))
            for side in self._sides
        )
        return bad - good, len(text)

    def difference(self, text: bytes) -> float:
        saved, size = self.raw(text)
        return (saved + PRIOR_BYTES * self._typical) / (size + PRIOR_BYTES)


def _dictionary(texts: list[bytes]) -> bytes:
    blocks = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, blocks)) // 10))
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        # Too little text to train on; the newest bytes count most.
        return b"".join(blocks)[-DICTIONARY_BYTES:] or b" " * 8


def isotonic(at: np.ndarray, value: np.ndarray) -> tuple[list[float], list[float]]:
    """The rising step curve closest to the values, as points to interpolate between."""
    order = np.argsort(at, kind="stable")
    levels: list[list[float]] = []
    for x, y in zip(at[order], value[order]):
        levels.append([y, 1.0, x, x])
        while len(levels) > 1 and levels[-2][0] / levels[-2][1] >= levels[-1][0] / levels[-1][1]:
            total, n, _, last = levels.pop()
            levels[-1][0] += total
            levels[-1][1] += n
            levels[-1][3] = last
    points = sorted({(p, s / n) for s, n, a, b in levels for p in (a, b)})
    return [float(p) for p, _ in points], [float(v) for _, v in points]


def fit(docs: DataFrame, labels: DataFrame, label: str = "label") -> QualityModel:
    """Fit on a bounded sample of ``docs(doc_id, text)`` with a label in ``labels``.

    The sample is the ``SAMPLE_DOCS`` ids of either label (0 or 1; other values
    and NULLs are left out) with the smallest digest, so it is the same in every
    run; of rows that share an id one text counts. Only these ids meet the
    documents, which are not shuffled. Every other document trains the
    dictionaries, the rest the curve. Without documents of both labels every
    text scores 0.5.
    """
    known = labels.where("doc_id IS NOT NULL").select(
        F.xxhash64("doc_id").alias("turn"), "doc_id", F.col(label).cast("int").alias("side")
    )
    ids = [
        (r["doc_id"], side)
        for side in (0, 1)
        for r in known.where(F.col("side") == side)
        .distinct()
        .orderBy("turn", "doc_id")
        .limit(SAMPLE_DOCS)
        .collect()
    ]
    sides: dict[int, list[bytes]] = {0: [], 1: []}
    if ids:
        # Twice SAMPLE_DOCS numbers at most.
        chosen = docs.sparkSession.createDataFrame(ids, "doc_id long, side int")
        head = F.expr(f"substring(cast(coalesce(text, '') AS binary), 1, {SAMPLE_BYTES})")
        rows = (
            docs.select("doc_id", head.alias("head"))
            .join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "side")
            .agg(F.min("head").alias("head"))
        )
        place = {key: k for k, key in enumerate(ids)}
        found = sorted(rows.collect(), key=lambda r: place[r["doc_id"], r["side"]])
        for r in found:
            sides[r["side"]].append(bytes(r["head"]))
    if any(len(texts) < 2 for texts in sides.values()):
        return QualityModel(b"good    ", b"bad     ", 0.0, [0.0], [0.5])
    good, bad = (_dictionary(sides[label][::2]) for label in (1, 0))
    plain = Differ(good, bad)
    measured = [(plain.raw(t), label) for label in (0, 1) for t in sides[label][1::2]]
    typical = float(np.median([s / n for (s, n), label in measured if label and n] or [0.0]))
    shrunk = np.array([(s + PRIOR_BYTES * typical) / (n + PRIOR_BYTES) for (s, n), _ in measured])
    labels = np.array([float(label) for _, label in measured])
    return QualityModel(good, bad, typical, *isotonic(shrunk, labels))


def score_texts(
    docs: DataFrame, model: QualityModel, text: str = "text", into: str = "score"
) -> DataFrame:
    """Add the score, from 0 to 1, of every whole text; NULL scores as an empty text.

    Other columns are kept, one of the new name is replaced.
    """
    kept = others(docs.schema.fields, [into])
    names = [f.name for f in kept]
    schema = StructType([*kept, StructField(into, DoubleType(), False)])
    # Two dictionaries and a curve of bounded size.
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        differ = Differ(m.good, m.bad, m.typical)
        for batch in chunks(batches, text):
            texts = column_bytes(batch, text)
            x = np.array([differ.difference(t) for t in texts])
            scores = np.interp(x, m.at, m.score)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(scores, pa.float64())],
                names=[*names, into],
            )

    return docs.mapInArrow(run, schema)


def held_out(doc_id: str | Column = "doc_id", parts: int = 5, part: int = 0) -> Column:
    """Whether a document is kept from training: by the checksum of its id as text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))
    return digest % parts == part
