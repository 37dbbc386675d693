import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from telltale.llm import merkle
from telltale.llm.queries import manifest_rows, registered
from tests_support import prose

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def build(level, arity=16):
    """The top of a tree, and for each leaf the (place, siblings) of its way up."""
    ways, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for way, i in zip(ways, at, strict=True):
            run = level[i // arity * arity :][:arity]
            way.append((i % arity, run[: i % arity] + run[i % arity + 1 :]))
        at = [i // arity for i in at]
        level = [digest(*level[i : i + arity]) for i in range(0, len(level), arity)]
    return level[0], ways


def brute(rows, arity=16):
    sources = collections.defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        claimed = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            claimed = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        own = leaf((doc_id, source, lang, n_chars, text))
        other = leaf((doc_id, source, lang, n_chars, claimed))
        sources[source].append((doc_id is not None, doc_id or 0, own, doc_id, other))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    if not order:
        return []
    trees = [build([x[2] for x in sorted(sources[s])], arity) for s in order]
    root, above = build([top for top, _ in trees], arity)
    found = []
    for source, (top, ways), rest in zip(order, trees, above, strict=True):
        for (_, _, own, doc_id, claimed), way in zip(sorted(sources[source]), ways, strict=True):
            now = claimed
            for place, others in way + rest:
                now = digest(*others[:place], now, *others[place:])
            siblings = [x for _, others in way + rest for x in others]
            found.append((doc_id, own, top, root, digest(*siblings), now, now == root))
    return sorted(found, key=str)


def proved(frame):
    return sorted((tuple(r) for r in manifest_rows(frame).select(*COLUMNS).collect()), key=str)


@pytest.fixture
def docs(spark):
    def make(rows):
        # Names that the operator uses inside, and one that differs in its case only.
        schema = (
            "doc_id long, source string, lang string, n_chars long, text string, "
            "Source string, tree long, h string, leaf string, steps string"
        )
        return spark.createDataFrame([(*r, "x", 1, "h", "l", "s") for r in rows], schema)

    return make


ODD = [
    (1, "a", "en", 3, "Some Text"),
    (1, "a", "en", 3, "Some Text"),
    (1, "a", "en", 3, "Another Text"),
    (None, "a", "en", 3, "Some Text"),
    (None, None, None, None, None),
    (2, None, "en", 0, ""),
    (3, "", "en", 0, None),
    (4, "alone", None, -5, "É漢字 \U0001f600"),
    (5, "b", "en", 9, prose(1, 30_000) + "Z"),
    (6, "b", "en", 9, "lower case only"),
]


def test_odd_rows(docs):
    assert proved(docs(ODD)) == brute(ODD)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 257])
def test_sizes_of_one_source(docs, n):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(n)]
    assert proved(docs(rows)) == brute(rows)


def test_many_sources_and_a_hot_one(docs, monkeypatch):
    monkeypatch.setattr("telltale.llm.ordering.ROWS_PER_PART", 100)
    monkeypatch.setattr("telltale.llm.ordering.ROWS_PER_BLOCK", 16)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 40}", "en", i, f"Text {i}") for i in range(900)]
    rows += [(i, f"alone{i}", "en", i, "T") for i in range(1000, 1020)]
    assert proved(docs(rows)) == brute(rows)


def test_small_runs_make_long_ways(spark):
    """With runs of two the ways have many levels, so the pointers jump several times."""
    rows = [(i, "s" if i < 70 else f"t{i % 5}", digest(str(i))) for i in range(90)]
    leaves = spark.createDataFrame(rows, "doc_id long, source string, leaf string")
    found = merkle.manifest(leaves, "source", "doc_id", "leaf", arity=2)
    rows_ = found.proofs.withColumn("again", merkle.folded(F.col("leaf"), F.col("steps"))).collect()
    assert len(rows_) == 90 and len({r["root"] for r in rows_}) == 1
    assert all(r["again"] == r["root"] for r in rows_)
    assert max(len(r["steps"]) for r in rows_) == 7 + 3
    tops = found.nodes.where("tree = -1").count()
    assert tops == 3 + 2 + 1


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    found = registered()["op12_merkle_manifest"](spark, sf_dir).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute([tuple(r) for r in docs.collect()])
    assert {r["verified"] for r in found} == {True, False}
