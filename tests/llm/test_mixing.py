import collections
import re

import pytest
from pyspark.sql import functions as F

from telltale.llm import mixing
from telltale.llm.queries import registered
from tests_support import prose


# Words of a block in these tests.
mix_words = 16


def shares(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by sharing again and again what full sources leave."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        among = sum(weight[s] for s in sizes if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / among for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def check(mix, docs, most=2):
    documents = mix.taken().collect()
    count = collections.Counter()
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in documents:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= most * r["size"]
        count[r["doc_id"], r["source"], r["size"]] += 1
    expected = collections.Counter((i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, s, t in docs)
    assert count == expected
    assert all(r["source_size"] == sizes[r["source"]] for r in documents)
    if not any(sizes.values()):
        assert not any(taken.values())
        return
    for source, words in shares(dict(sizes)).items():
        assert target[source] == pytest.approx(words)
        assert abs(taken[source] - words) <= 0.5

    # Slots: blocks of a source in order, and no stretch far from the weights.
    slots = mix.slots.orderBy("slot").collect()
    total = collections.Counter(r["source_no"] for r in slots)
    seen = collections.Counter()
    for i, r in enumerate(slots, 1):
        assert r["block"] == seen[r["source_no"]]
        seen[r["source_no"]] += 1
        for s, n in total.items():
            assert abs(seen[s] - n * i / len(slots)) <= 2 + len(slots).bit_length()
    # Pieces: a slot is full but for the last one of a source, and laps are whole.
    held = collections.Counter()
    words = collections.Counter()
    for r in mix.pieces.collect():
        held[r["slot"]] += r["to_word"] - r["from_word"]
        for w in range(r["from_word"], r["to_word"]):
            words[r["row"], w] += 1
    assert len(held) == len(slots) and max(words.values()) <= most
    short = [r["slot"] for r in slots if held[r["slot"]] < mix_words]
    assert len(short) <= len(total) and max(held.values()) <= mix_words


@pytest.fixture
def docs(spark):
    def make(rows):
        schema = "doc_id long, source string, text string, Text string, row long, size string, target string"
        return spark.createDataFrame([(*r, "x y", 1, "s", "t") for r in rows], schema)

    return make


ODD = [
    (1, "a", "one two"),
    (1, "a", "one two"),
    (None, "a", "three"),
    (None, None, None),
    (2, None, " \t\n\x0b\x0c\r "),
    (3, None, "  x\u00a0y z"),
    (4, "", ""),
    (5, "é", "w " * 3000),
    (6, "z", prose(3, 500)),
    (7, "b", "a"),
]


def test_odd_rows(docs):
    mix = mixing.mix_sources(docs(ODD), block_words=mix_words)
    found = {r["doc_id"]: r["size"] for r in mix.documents.collect()}
    # Only the six breaks part words.
    assert found[3] == 2 and found[2] == 0 and found[4] == 0
    check(mix, ODD)


def test_nothing_to_mix(docs):
    assert mixing.mix_sources(docs([])).taken().collect() == []
    rows = [(1, "a", ""), (2, None, None)]
    check(mixing.mix_sources(docs(rows), block_words=mix_words), rows)


def test_a_hot_source_and_full_ones(docs, monkeypatch):
    """One source has half of the words; small ones are wanted beyond twice their size."""
    monkeypatch.setattr("telltale.llm.ordering.ROWS_PER_PART", 40)
    monkeypatch.setattr("telltale.llm.ordering.ROWS_PER_BLOCK", 8)
    monkeypatch.setattr(mixing, "_CELLS", 16)
    rows = [(i, "hot" if i % 2 else f"s{i % 7}", prose(i, 1 + i % 60)) for i in range(300)]
    rows += [(1000, "tiny", "a b c")]
    mix = mixing.mix_sources(docs(rows), block_words=mix_words)
    check(mix, rows)
    again = mixing.mix_sources(docs(rows[::-1]), block_words=mix_words)
    kept = ("doc_id", "size", "taken")
    assert sorted(map(tuple, mix.taken().select(*kept).collect())) == sorted(
        map(tuple, again.taken().select(*kept).collect())
    )


def test_van_der_corput(spark):
    found = spark.range(8).select(mixing.van_der_corput(F.col("id"), 3).alias("v"))
    assert [r["v"] for r in found.collect()] == [0, 4, 2, 6, 1, 5, 3, 7]


def test_no_python_in_tasks(spark, sf_dir, plan):
    found = registered()["op13_source_mixing"](spark, sf_dir)
    assert "Python" not in plan(found) and "Arrow" not in plan(found)
    rows = found.collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r["source_size"]] += r["size"]
        assert r["taken"] <= 2 * r["size"]
    assert sum(r["taken"] for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), abs=20)
