import zlib

import numpy as np
import pytest

from telltale.llm import compression_quality as quality
from tests_support import prose


def test_isotonic():
    at, score = quality.isotonic(np.array([3.0, 1.0, 2.0, 4.0, 5.0]), np.array([1.0, 0.0, 1.0, 0.0, 1.0]))
    assert at == sorted(at) and score == sorted(score)
    assert np.interp([0, 1, 2, 4, 9], at, score).tolist() == pytest.approx([0, 0, 2 / 3, 2 / 3, 1])


def labelled_rows():
    good = [(k, prose(k, 80), 1) for k in range(60)]
    bad = [(100 + k, prose(k, 80).upper().replace(" ", "!! "), 0) for k in range(60)]
    return [*good, *bad]


def fitted(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, n) for i, _, n in rows], "doc_id long, label int")
    return quality.fit(docs, labels)


@pytest.fixture
def model(spark):
    odd = [(900, None, 1), (901, "x", None), (902, "y", 5), (None, "z", 0), (3, "again", 1)]
    return fitted(spark, [*labelled_rows(), *odd])


def test_scores(make_docs, odd_rows, model):
    docs = make_docs([*odd_rows, (70, prose(70, 90)), (71, prose(71, 90).upper().replace(" ", "!! "))])
    scored = quality.score_texts(docs, model)
    assert set(scored.columns) == set(docs.columns)
    found = scored.collect()
    assert len(found) == len(odd_rows) + 2
    assert all(0 <= r["score"] <= 1 for r in found)
    by_id = {r["doc_id"]: r["score"] for r in found}
    assert by_id[70] > 0.8 and by_id[71] < 0.2
    assert by_id[4] == by_id[5] >= 0.3
    assert quality.score_texts(make_docs([]), model).collect() == []


def test_without_labels(spark, make_docs):
    found = quality.score_texts(make_docs([(1, "a"), (2, None)]), fitted(spark, [])).collect()
    assert [r["score"] for r in found] == [0.5, 0.5]


def test_sample_does_not_depend_on_the_order_of_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_DOCS", 40)
    rows = labelled_rows()
    assert fitted(spark, rows) == fitted(spark, rows[::-1])


def test_held_out(spark):
    ids = spark.createDataFrame([(k,) for k in range(50)], "doc_id long")
    out = {r["doc_id"] for r in ids.where(quality.held_out()).collect()}
    assert out == {k for k in range(50) if zlib.crc32(str(k).encode()) % 5 == 0}


def test_query(spark):
    """On labels that it has not seen."""
    import os

    import duckdb

    from telltale.llm.queries import registered

    sf_dir = "/root/testdata/sf0.01"
    if not os.path.isdir(sf_dir):
        pytest.skip("test tables absent")
    found = {r["doc_id"]: r for r in registered()["op10_quality_classifier"](spark, sf_dir).collect()}
    labels = duckdb.connect().execute(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet'").fetchall()
    right = total = 0
    for i, label in labels:
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        if found[i]["held_out"]:
            total += 1
            right += found[i]["predicted"] == label
    assert right > 0.9 * total
