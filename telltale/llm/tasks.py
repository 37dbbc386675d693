"""What the operators share: words, chunks of Arrow batches and code for the executors."""

from __future__ import annotations

import importlib
import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from telltale.session import run_dir

# Words are runs of anything but these: space, \t, \n, \v, \f and \r. On bytes
# that is what split() without an argument does.
WORD_BREAKS = "\x20\t\n\x0b\x0c\r"
WORD_BREAK_PATTERN = r"[\x20\x09-\x0D]+"

# Rows hold whole texts, so a batch on its way to Python holds few of them.
ROWS_PER_BATCH, BYTES_PER_BATCH = 1024, 8 << 20
_BATCH = "spark.sql.execution.arrow.max{}PerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application.

    Their Python need not have it on its path. Also bounds the rows of Arrow
    batches of the session, if they are not bounded as tightly already.
    """
    for what, most in (("Records", ROWS_PER_BATCH), ("Bytes", BYTES_PER_BATCH)):
        now = spark.conf.get(_BATCH.format(what)).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(_BATCH.format(what), f"{most}")
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = __name__.split(".")[0]
        top = os.path.dirname(importlib.import_module(package).__file__)
        path = os.path.join(tempfile.mkdtemp(prefix=f"{package}-code-"), f"{package}.zip")
        with zipfile.ZipFile(path, "w") as packed:
            for folder, _, names in os.walk(top):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.join(package, os.path.relpath(full, top)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


def chunks(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20, most_rows: int = 4096
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a chunk holds about so many bytes of a text or binary column.

    A single value may be longer; no value is ever cut.
    """
    for batch in batches:
        sizes = [len(v) for v in _views(batch.column(column))]
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > most_bytes or i - start >= most_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def _views(array: pa.Array) -> list:
    return [v.as_buffer() or b"" for v in array.cast(pa.large_binary())]


def column_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The values of a text or binary column as bytes, NULL as no bytes."""
    return [v or b"" for v in batch.column(column).cast(pa.binary()).to_pylist()]


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    Cuts the lineage: what is derived from it survives a lost executor without
    running again what lies before.
    """
    path = run_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def only(frame: DataFrame, *names: str) -> DataFrame:
    """Some columns of a table that may hold others with the same names in another case.

    Of such columns the one that is written as asked counts.
    """
    at = [place_of(frame.columns, n) for n in names]
    held = frame.toDF(*[f"c{i}" for i in range(len(frame.columns))])
    return held.select(*[F.col(f"c{i}").alias(n) for i, n in zip(at, names, strict=True)])


def place_of(columns: Sequence[str], name: str) -> int:
    """Which column is meant by a name: one that is written so, else one in another case."""
    alike = [i for i, c in enumerate(columns) if c.lower() == name.lower()]
    exact = [i for i in alike if columns[i] == name] or alike
    if not exact:
        raise ValueError(f"no column {name} in {list(columns)}")
    return exact[0]


def others(fields: Sequence[StructField], new: Iterable[str]) -> list[StructField]:
    """The fields that stay when columns of new names come, whatever case they are in."""
    taken = {n.lower() for n in new}
    return [f for f in fields if f.name.lower() not in taken]


def word_count(text: Column) -> Column:
    """How many words a text has; NULL has none.

    Every word with the breaks around it becomes one character, so no list of words is made.
    """
    breaks, word = r"[\x20\x09-\x0D]*+", r"[^\x20\x09-\x0D]++"
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), breaks + word + breaks, "x")
    return F.length(F.translate(marks, WORD_BREAKS, "")).cast("bigint")


def mounted(path: str) -> str:
    """The local name of a folder that all machines mount, for files mapped into memory."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(
            f"{path}: files that workers map into memory need a shared folder with a "
            "path of its own on every machine (spark.checkpoint.dir as file:/...)"
        )
    return parts.path
