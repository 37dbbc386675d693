"""Token ids in Arrow files of equal-length sequences that are read without a copy.

A folder holds per range of documents one file of sequences and one of document
places. A sequence file is an Arrow IPC file with record batches of a fixed
number of rows: ``ids`` a fixed-size list of unsigned integers, ``mask`` a
fixed-size list of booleans that is false after the last id of the file. Rows
lie one behind the other in the mapped file, so row i of batch j is an offset.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telltale.llm.bpe import LibraryUnits, Vocabulary, per_worker, tokenizer_spec
from telltale.llm.tasks import chunks, mounted, only, ship

ROWS_PER_BATCH = 256
# Places of so many documents are kept by the task that writes a file.
DOCS_PER_FILE = 100_000

_FILE = "file string, n_docs long, n_tokens long, n_sequences long"
_PLACE = "doc_id long, file string, at long, n_tokens long, ids binary"


def id_type(top: int) -> pa.DataType:
    return pa.uint16() if top < 1 << 16 else pa.uint32()


class SequenceWriter:
    """Cuts a stream of ids into sequences; the last one is padded."""

    def __init__(self, path: str, length: int, kind: pa.DataType):
        self._length, self._kind = length, kind.to_pandas_dtype()
        self._schema = pa.schema(
            [("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))]
        )
        self._file = pa.OSFile(path, "wb")
        self._out = pa.ipc.new_file(self._file, self._schema)
        self._held: list[np.ndarray] = []
        self._n_held = 0
        self.n_tokens = self.n_sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self._held.append(ids.astype(self._kind))
        self._n_held += len(ids)
        self.n_tokens += len(ids)
        whole = ROWS_PER_BATCH * self._length
        if self._n_held >= whole:
            flat = np.concatenate(self._held)
            cut = len(flat) // whole * whole
            for start in range(0, cut, whole):
                self._write(flat[start : start + whole], whole)
            self._held, self._n_held = [flat[cut:]], len(flat) - cut

    def _write(self, flat: np.ndarray, n_real: int) -> None:
        mask = np.arange(len(flat)) < n_real
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(x), type=self._schema.field(name).type)
            for name, x in (("ids", flat), ("mask", mask))
        ]
        self._out.write_batch(pa.record_batch(columns, schema=self._schema))
        self.n_sequences += len(flat) // self._length

    def close(self) -> None:
        if self._n_held:
            flat = np.concatenate(self._held)
            padded = np.zeros(-(-len(flat) // self._length) * self._length, self._kind)
            padded[: len(flat)] = flat
            self._write(padded, len(flat))
        self._out.close()
        self._file.close()


class SequenceFile:
    """A mapped file. Sequences and runs of ids are views of it."""

    def __init__(self, path: str):
        self._map = pa.memory_map(path)
        reader = pa.ipc.open_file(self._map)
        batches = [reader.get_batch(i) for i in range(reader.num_record_batches)]
        # All batches but the last have as many rows as the first.
        self._rows = batches[0].num_rows if batches else 1
        self.length = reader.schema.field("ids").type.list_size
        self._flat = [b.column("ids").flatten().to_numpy(zero_copy_only=True) for b in batches]
        self._masks = [b.column("mask") for b in batches]

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of a sequence."""
        batch, row = divmod(i, self._rows)
        at = row * self.length
        return self._flat[batch][at : at + self.length], self._masks[batch][row].values

    def ids(self, start: int, n: int) -> np.ndarray:
        """So many ids from a place of the stream on; a copy only across batches."""
        size = self._rows * self.length
        parts = []
        while n > 0:
            batch, at = divmod(start, size)
            part = self._flat[batch][at : at + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint16)])


def _ranged(docs: DataFrame, files: int) -> DataFrame:
    """Documents in order, cut into ranges of about equally many.

    Ids alone make the ranges, which is a pass over one column, unless an id, or
    none, has more rows than half a file: then cuts fall within its rows too.
    """
    order = [
        F.col("doc_id").asc_nulls_last(),
        F.substring("text", 1, 64).asc_nulls_first(),
        F.xxhash64("text").asc(),
    ]
    most, rows = (
        docs.groupBy("doc_id").agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    )
    if 2 * files * (most or 0) <= (rows or 0):
        return docs.repartitionByRange(files, order[0]).sortWithinPartitions(*order)
    keyed = docs.withColumn("row", F.monotonically_increasing_id())
    order = [*order, F.col("row").asc()]
    return keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("row")


def write_sequences(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    length: int = 2048,
    files: int | None = None,
) -> DataFrame:
    """Write ``docs(doc_id, text)`` in ascending ``doc_id`` order; returns the files.

    Every document is encoded and closed by ``end_id``; a NULL text is only that
    id. Documents with one id follow each other by the first 64 characters of their text,
    then by its digest; those without an id come last. A range of documents goes to one file, so a lost task repeats one file;
    files get their final name only when they are whole. An empty table gives no
    files. Only the two columns are read, whatever else there is.
    """
    spark = ship(docs.sparkSession)
    local = mounted(folder)
    text = tokenizer_spec(tokenizer)
    kind = id_type(max(end_id + 1, len(Vocabulary(text).tokens)))
    spec = spark.sparkContext.broadcast(text)
    docs = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    if files is None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        files = max(least, -(-docs.count() // DOCS_PER_FILE))
    ranged = _ranged(docs, files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = per_worker(LibraryUnits, spec.value)
        context = TaskContext.get()
        name = f"{context.partitionId():06d}"
        os.makedirs(local, exist_ok=True)
        half = os.path.join(local, f".{name}-{context.taskAttemptId()}")
        writer, ids, sizes = None, [], []
        end = np.array([end_id], "<u4")
        for batch in chunks(batches, "text"):
            writer = writer or SequenceWriter(half, length, kind)
            found = [np.append(ids, end) for ids in units.many(batch.column("text"))]
            writer.add(np.concatenate(found))
            ids += batch.column("doc_id").to_pylist()
            sizes += [len(f) for f in found]
        if writer is None:
            return
        writer.close()
        n = np.array(sizes, np.int64)
        places = pa.table({"doc_id": pa.array(ids, pa.int64()), "at": n.cumsum() - n, "n_tokens": n})
        with pa.OSFile(half + "-places", "wb") as file, pa.ipc.new_file(file, places.schema) as out:
            out.write_table(places, max_chunksize=65536)
        os.rename(half + "-places", os.path.join(local, f"{name}.places.arrow"))
        os.rename(half, os.path.join(local, f"{name}.arrow"))
        row = [[name], [len(ids)], [writer.n_tokens], [writer.n_sequences]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, (pa.string(), *[pa.int64()] * 3))],
            names=["file", "n_docs", "n_tokens", "n_sequences"],
        )

    return ranged.mapInArrow(run, _FILE)


def read_places(files: DataFrame, folder: str) -> DataFrame:
    """All documents of written files with their ids: one task reads some files.

    ``at`` is the place in the file; ids come as unsigned 32-bit integers.
    """
    ship(files.sparkSession)
    local = mounted(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                sequences = SequenceFile(os.path.join(local, f"{name}.arrow"))
                places = pa.ipc.open_file(pa.memory_map(os.path.join(local, f"{name}.places.arrow")))
                for i in range(places.num_record_batches):
                    part = places.get_batch(i)
                    for start in range(0, part.num_rows, 1024):
                        cut = part.slice(start, 1024)
                        ids = [
                            sequences.ids(at, n).astype("<u4").tobytes()
                            for at, n in zip(
                                cut.column("at").to_pylist(), cut.column("n_tokens").to_pylist()
                            )
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [
                                cut.column("doc_id"),
                                pa.array([name] * cut.num_rows, pa.string()),
                                cut.column("at"),
                                cut.column("n_tokens"),
                                pa.array(ids, pa.binary()),
                            ],
                            names=["doc_id", "file", "at", "n_tokens", "ids"],
                        )

    tasks = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.select("file").repartition(tasks).mapInArrow(run, _PLACE)


def with_starts(places: DataFrame, files: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before: the files before, then the place.

    The sum over files runs in one task over one row per file.
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    first = files.select(
        "file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first")
    )
    return places.join(first, "file").withColumn("start", F.col("first") + F.col("at"))
