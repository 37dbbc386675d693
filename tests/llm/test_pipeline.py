import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from telltale.llm import decontaminate, simhash
from test_substrings import slow_cut
from tests_support import brute_components, prose


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "near_dedup", "substring_dedup", "decontamination", "encoding",
    ]


def test_against_brute_force(spark, tmp_path, tokenizer):
    """Stages after the classifier, whose labels here give it nothing to reject."""
    item = prose(900, 25)
    passage = prose(901, 60)
    rows = [(k, prose(k, 150)) for k in range(25)]
    rows += [(30, rows[4][1]), (31, rows[6][1]), (31, rows[6][1]), (None, rows[7][1]), (32, None), (33, "")]
    rows += [(40 + k, prose(40 + k, 90) + " " + passage + " " + prose(60 + k, 70)) for k in range(4)]
    rows += [(50, prose(50, 80) + " " + item + " " + prose(51, 80))]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), "x") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, extra string",
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()

    values = [np.uint64(simhash.fingerprint((t or "").encode())) for _, t in rows]
    groups = brute_components(values, 3)
    first = {}
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k)):
        first.setdefault(groups[k], rows[k])
    kept = sorted(first.values(), key=lambda r: (r[0] is None, r[0] or 0))
    cut = slow_cut(kept, 20)
    texts = [" ".join(left) if n else t for (_, t), (left, n) in zip(kept, cut)]
    index = decontaminate.Index([(1, item)], decontaminate.EDIT_RATE)
    bad = {r[0] for r in index.search([t or "" for t in texts])}
    library = Tokenizer.from_file(tokenizer)
    expected = {
        i: library.encode(t or "", add_special_tokens=False).ids
        for k, ((i, _), t) in enumerate(zip(kept, texts))
        if k not in bad
    }
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in found} == expected
    assert len(found) == len(expected) and all(r["round_trip"] for r in found)
    assert 50 not in expected and 30 not in expected and None not in expected


@pytest.mark.parametrize("k", range(4))
def test_columns_are_those_of_documents(spark, sf_dir, k):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert corpus_pipeline.STAGES[k][1](spark, docs, sf_dir).schema == docs.schema


def test_empty(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []


def test_clean_documents_pass(spark, sf_dir):
    """Good documents without copies, shared passages or benchmark text come through whole."""
    import duckdb

    found = {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    duck = duckdb.connect()
    good = duck.execute(
        f"SELECT doc_id FROM '{sf_dir}/labels.parquet' WHERE quality = 1"
    ).fetchall()
    docs = duck.execute(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY 1").fetchall()
    bench = duck.execute(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    values = [np.uint64(simhash.fingerprint((t or "").encode())) for _, t in docs]
    group = dict(zip((i for i, _ in docs), brute_components(values, 3, [i for i, _ in docs])))
    leaks = decontaminate.Index(bench, decontaminate.EDIT_RATE).search([t or "" for _, t in docs])
    leaked = {docs[r[0]][0] for r in leaks}
    clean = {i for (i,) in good if group[i] == i and i not in leaked}
    assert len(clean - found) <= 0.03 * len(clean)
