import hashlib
import random
import re

import numpy as np
import pytest

from telltale.llm import substrings
from tests_support import thue_morse


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def slow_cut(rows, window):
    """Rows in the order of the corpus; words left and removed of each."""
    seen, out = set(), []
    for _, text in rows:
        words, cover = words_of(text), set()
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if key in seen:
                cover.update(range(k, k + window))
            seen.add(key)
        out.append(([w for k, w in enumerate(words) if k not in cover], len(cover)))
    return out


def corpus(n=40, seed=4):
    """Texts with shared passages in other surroundings, copies and loops."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    shared = [[draw.choice(vocabulary) for _ in range(draw.randint(20, 60))] for _ in range(5)]
    rows = []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(0, 120))]
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(words))
            words[at:at] = draw.choice(shared)
        if i % 9 == 0:
            words += ["loop", "de"] * 30
        rows.append((i, " \n".join(words)))
    return rows + [(n, rows[3][1]), (n + 1, rows[5][1] + " x")]


@pytest.mark.parametrize("window", [20, 7])
@pytest.mark.parametrize("crowd, shard", [(2000, 1 << 18), (3, 300)])
def test_against_all_windows(make_docs, monkeypatch, window, crowd, shard):
    monkeypatch.setattr(substrings, "ANCHOR_SEGMENTS", crowd)
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard)
    rows = corpus()
    found = {r["doc_id"]: r for r in substrings.cut_repeats(make_docs(rows), window).collect()}
    expected = slow_cut(rows, window)
    assert sum(n for _, n in expected) > 500
    for (i, text), (left, removed) in zip(rows, expected):
        assert (found[i]["n_words"], found[i]["n_removed"]) == (len(words_of(text)), removed)
        assert found[i]["text"] == (" ".join(left) if removed else text)


def test_fm_index_counts_every_pattern():
    draw = np.random.default_rng(2)
    text = np.r_[draw.integers(1, 6, 300), 0]
    index = substrings.FmIndex(text, 6, 6)
    for size in range(1, 7):
        for at in range(0, 290, 7):
            pattern = text[at : at + size]
            low, high = index.whole(1)
            for symbol in pattern[::-1]:
                low, high = index.extend(np.array([symbol]), low, high)
            where = [i for i in range(len(text) - size + 1) if (text[i : i + size] == pattern).all()]
            assert high[0] - low[0] == len(where)
            assert index.earliest(low, high)[0] == where[0]


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    found = substrings.cut_repeats(docs)
    assert found.columns == [*[c for c in docs.columns if c != "n_words"], "n_words", "n_removed"]
    left = {}
    for r in found.collect():
        left.setdefault((r["doc_id"], r["n_words"]), []).append(r["n_removed"])
    size = len(words_of(odd_rows[0][1]))
    # Repeated rows are one document; an id comes before none.
    assert left[3, size] == [0, 0]
    assert left[7, size] == [size] and left[None, size] == [size]
    assert left[13, size + 200] == [size]
    assert left[10, 500] == [499]
    assert left[4, 0] == [0] and left[5, 0] == [0] and left[6, 0] == [0]


def test_words_in_a_pattern_are_different_words(make_docs):
    """Two texts that differ in one word of 1,024 characters repeat nothing."""
    rows = []
    for k, word in enumerate((thue_morse(1024), thue_morse(1024, "ba"))):
        words = [f"w{i}" for i in range(25)]
        words[12] = word
        rows.append((k, " ".join(words)))
    found = substrings.cut_repeats(make_docs(rows))
    assert [r["n_removed"] for r in found.collect()] == [0, 0]


def test_rows_without_an_id(spark, make_docs):
    """Each is a document of its own text, also where 32 bits of a digest agree."""
    pool = spark.range(300_000).selectExpr("concat('t', id) AS t", "hash(concat('t', id)) AS h")
    first, second = pool.groupBy("h").agg({"t": "max", "*": "count", "h": "min"}).where(
        "`count(1)` > 1"
    ).join(pool, "h").select("t").limit(2).toPandas()["t"]
    shared = " ".join(f"s{i}" for i in range(40))
    short, long = first, f"{second}"
    rows = [(None, f"{shared} only {k} " + " ".join(f"u{k}_{i}" for i in range(30))) for k in range(1000)]
    rows += [(None, short), (None, long), (1, shared)]
    found = substrings.cut_repeats(make_docs(rows)).collect()
    cut = sorted((r["n_words"], r["n_removed"]) for r in found)
    # The word behind the shared ones is repeated too, but for the first of these rows.
    assert cut == sorted([(72, 41)] * 999 + [(72, 40), (1, 0), (1, 0), (40, 0)])


def test_columns_with_clashing_names(spark):
    shared = " ".join(f"s{i}" for i in range(30))
    frame = spark.createDataFrame(
        [(1, shared, 5, "x", 7), (2, shared, 6, "y", 8)],
        "doc_id long, text string, N_WORDS int, tie string, own_id int",
    )
    found = substrings.cut_repeats(frame)
    assert found.columns == ["doc_id", "text", "tie", "own_id", "n_words", "n_removed"]
    assert sorted(map(tuple, found.collect())) == [(1, shared, "x", 7, 30, 0), (2, "", "y", 8, 30, 30)]


def test_empty(make_docs):
    assert substrings.cut_repeats(make_docs([])).collect() == []


def test_query(spark, sf_dir, documents):
    from telltale.llm.queries import registered

    found = {r["doc_id"]: r for r in registered()["op6_substring_dedup"](spark, sf_dir).collect()}
    for (i, text), (left, removed) in zip(documents, slow_cut(documents, 20)):
        digest = hashlib.sha256(" ".join(left).encode()).hexdigest()
        assert tuple(found[i]) == (i, len(words_of(text)), removed, digest)
