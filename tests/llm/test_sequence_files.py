import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from telltale.llm import sequence_files
from telltale.session import run_dir
from tests_support import thue_morse


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))


@pytest.mark.parametrize("length, per_batch", [(16, 4), (2048, 256)])
def test_round_trip(spark, make_docs, odd_rows, tokenizer, monkeypatch, length, per_batch):
    monkeypatch.setattr(sequence_files, "ROWS_PER_BATCH", per_batch)
    folder = run_dir(spark, "sequences")
    files = sequence_files.write_sequences(make_docs(odd_rows), folder, tokenizer, 0, length, 3)
    files = spark.createDataFrame(files.collect(), files.schema)
    library = Tokenizer.from_file(tokenizer)
    expected, start = [], 0
    for i, text in ordered(odd_rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((i, start, len(ids), struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    places = sequence_files.with_starts(sequence_files.read_places(files, folder), files)
    found = [(r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in places.collect()]
    assert sorted(found, key=lambda r: r[1]) == expected
    for r in files.collect():
        path = os.path.join(folder, f"{r['file']}.arrow")
        mapped = sequence_files.SequenceFile(path)
        ids, mask = mapped.sequence(r["n_sequences"] - 1)
        assert len(ids) == len(mask) == length
        used = r["n_tokens"] - length * (r["n_sequences"] - 1)
        assert mask.to_pylist() == [k < used for k in range(length)]
        assert not np.any(ids[used:])
        assert not any(name.startswith(".") for name in os.listdir(folder))


def test_rows_of_one_id_lie_in_many_files(spark, make_docs, tokenizer):
    rows = [(None, f"text {i % 50}") for i in range(400)] + [(1, "first")]
    folder = run_dir(spark, "sequences")
    files = sequence_files.write_sequences(make_docs(rows), folder, tokenizer, files=8)
    files = spark.createDataFrame(files.collect(), files.schema)
    counts = [r["n_docs"] for r in files.collect()]
    assert len(counts) == 8 and sum(counts) == 401 and max(counts) < 100
    places = sequence_files.with_starts(sequence_files.read_places(files, folder), files)
    found = sorted(places.select("start", "n_tokens", "doc_id").collect())
    assert found[0]["doc_id"] == 1
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(found, found[1:]))


def test_words_in_a_pattern(spark, make_docs, tokenizer):
    """Words on which sums of powers agree keep their own ids."""
    rows = [(k, f"a {thue_morse(1024, letters)} b") for k, letters in enumerate(("ab", "ba"))]
    folder = run_dir(spark, "sequences")
    files = sequence_files.write_sequences(make_docs(rows), folder, tokenizer, files=1)
    files = spark.createDataFrame(files.collect(), files.schema)
    library = Tokenizer.from_file(tokenizer)
    for r in sequence_files.read_places(files, folder).collect():
        ids = [*library.encode(rows[r["doc_id"]][1], add_special_tokens=False).ids, 0]
        assert bytes(r["ids"]) == struct.pack(f"<{len(ids)}I", *ids)


def test_views_are_no_copies(tmp_path):
    writer = sequence_files.SequenceWriter(str(tmp_path / "x"), 8, pa.uint16())
    writer.add(np.arange(5000))
    writer.close()
    before = pa.total_allocated_bytes()
    mapped = sequence_files.SequenceFile(str(tmp_path / "x"))
    assert mapped.sequence(3)[0].tolist() == list(range(24, 32))
    assert mapped.ids(2047, 3).tolist() == [2047, 2048, 2049]
    assert pa.total_allocated_bytes() - before < 4096


def test_empty(spark, make_docs, tokenizer):
    folder = run_dir(spark, "sequences")
    assert sequence_files.write_sequences(make_docs([]), folder, tokenizer).collect() == []


def test_remote_folder_is_refused(make_docs, tokenizer):
    with pytest.raises(ValueError, match="shared folder"):
        sequence_files.write_sequences(make_docs([]), "hdfs://n/x", tokenizer)


def test_query(spark, sf_dir, documents, tokenizer):
    from telltale.llm.queries import registered

    library = Tokenizer.from_file(tokenizer)
    found = {r["doc_id"]: tuple(r)[1:] for r in registered()["op8_sequence_files"](spark, sf_dir).collect()}
    start = 0
    for i, text in documents:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert found[i] == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
