import pytest
from tokenizers import Tokenizer

from telltale.llm import token_counts


def lengths_of(rows, tokenizer):
    library = Tokenizer.from_file(tokenizer)
    return [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]


@pytest.mark.parametrize("per_block", [4096, 8])
def test_sums(spark, make_docs, odd_rows, tokenizer, monkeypatch, per_block):
    monkeypatch.setattr(token_counts, "LENGTHS_PER_BLOCK", per_block)
    lengths = lengths_of(odd_rows, tokenizer)
    histogram = token_counts.length_histogram(make_docs(odd_rows), tokenizer)
    sums = token_counts.length_sums(histogram)
    found = {r["length"]: r for r in sums.collect()}
    assert set(found) == set(lengths)
    for at, r in found.items():
        assert r["n_docs"] == lengths.count(at)
        assert r["docs_upto"] == sum(n <= at for n in lengths)
        assert r["docs_beyond"] == sum(n > at for n in lengths)
        assert r["tokens_upto"] == sum(n for n in lengths if n <= at)
        assert r["tokens_kept"] == sum(min(n, at) for n in lengths)
        assert (r["docs"], r["tokens"]) == (len(lengths), sum(lengths))
    limits = [0, 1, 3, 17, 100, 511, 10_000, 10_000_000]
    asked = spark.createDataFrame([(n,) for n in [*limits, 17, None, -1]], "limit long")
    for r in token_counts.truncated_totals(sums, asked).collect():
        limits.remove(r["limit"])
        assert r["tokens_kept"] == sum(min(n, r["limit"]) for n in lengths)
        assert r["docs_cut"] == sum(n > r["limit"] for n in lengths)
    assert not limits
    shares = {r["share"]: r["length"] for r in token_counts.length_quantiles(sums, [0.0, 0.5, 1.0]).collect()}
    ordered = sorted(lengths)
    assert shares == {0.0: ordered[0], 0.5: ordered[-(-len(ordered) // 2) - 1], 1.0: ordered[-1]}


def test_empty(spark, make_docs, tokenizer):
    sums = token_counts.length_sums(token_counts.length_histogram(make_docs([]), tokenizer))
    assert sums.collect() == []
    asked = spark.createDataFrame([(5,)], "limit long")
    assert [tuple(r) for r in token_counts.truncated_totals(sums, asked).collect()] == [(5, 0, 0, 0)]


def test_query(spark, sf_dir, documents, tokenizer):
    from telltale.llm.queries import registered

    lengths = lengths_of(documents, tokenizer)
    found = registered()["op5_token_counts"](spark, sf_dir).collect()
    assert {r["length"]: r["n_docs"] for r in found} == {n: lengths.count(n) for n in lengths}
    assert all(r["tokens_kept"] == sum(min(n, r["length"]) for n in lengths) for r in found)
