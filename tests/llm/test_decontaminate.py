import random
import tracemalloc

import numpy as np
import pytest

from telltale.llm import decontaminate as dec
from tests_support import prose


def fewest_edits(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        row = [i]
        for j, x in enumerate(text, 1):
            row.append(min(before[j - 1] + (c != x), before[j] + 1, row[j - 1] + 1))
        before = row
    return min(before)


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return " ".join(low.split())


def damaged(draw, text, edits):
    letters = list(text)
    for _ in range(edits):
        at, kind = draw.randrange(len(letters)), draw.randint(0, 2)
        if kind == 0:
            letters[at] = draw.choice("qxz")
        elif kind == 1:
            letters.insert(at, draw.choice("qxz"))
        else:
            del letters[at]
    return "".join(letters)


def test_against_full_alignment():
    """Found just where the whole text has an alignment within the budget, with its edits."""
    draw = random.Random(8)
    items = [(k, prose(200 + k, draw.randint(8, 30))) for k in range(12)]
    index = dec.Index(items, dec.EDIT_RATE)
    found = 0
    for trial in range(80):
        item, text = draw.choice(items)
        own = plain(text)
        budget = next(p.edits for p in index.patterns if p.item == item)
        place = damaged(draw, own, draw.randint(0, budget + 4))
        whole = prose(trial, draw.randint(0, 30)) + " " + place + " " + prose(-trial, draw.randint(0, 20))
        rows = [r for r in index.search(["before", whole, ""]) if r[1] == item]
        edits = fewest_edits(own, plain(whole))
        assert bool(rows) == (edits <= budget)
        if rows:
            found += 1
            assert min(r[5] for r in rows) == edits and {r[0] for r in rows} == {1}
            best = min(rows, key=lambda r: r[5])
            assert fewest_edits(plain(whole[best[3] : best[4]]), own) <= edits
    assert 20 < found < 80


def test_a_text_of_one_character_takes_little_memory():
    """Each place of the text meets each of the item; counted in lots, in few bands."""
    index = dec.Index([(1, "-" * 320)], dec.EDIT_RATE)
    tracemalloc.start()
    rows = index.search(["-" * 100_000, "other"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20
    assert rows and {r[:2] for r in rows} == {(0, 1)} and {r[5] for r in rows} == {0}


def test_lots_change_nothing(monkeypatch):
    items = [(k, prose(k, 12)) for k in range(6)] + [(7, "ab" * 60)]
    texts = [prose(3, 60), "ab" * 90 + prose(2, 40), "x" + "ab" * 59]
    expected = dec.Index(items, dec.EDIT_RATE, 60).search(texts)
    monkeypatch.setattr(dec, "HITS", 7)
    assert dec.Index(items, dec.EDIT_RATE, 60).search(texts) == expected != []


def test_long_items_are_found_in_part():
    item = prose(300, 400)
    index = dec.Index([(5, item)], dec.EDIT_RATE)
    text = prose(301, 50) + " " + item[400:1200] + " " + prose(302, 50)
    assert {r[1] for r in index.search([text])} == {5}
    assert not index.search([prose(303, 500)])


def test_short_excerpts(spark, make_docs):
    """85 % of an item of 250 characters, 290 of 390 and the least part that is promised."""
    draw = random.Random(9)
    texts = {k: plain(prose(600 + k, 200))[:n].strip() for k, n in ((1, 250), (2, 390), (3, 390))}
    part = 3 * dec.EXCERPT // 2
    cuts = {1: texts[1][20:232], 2: texts[2][60:350], 3: texts[3][37 : 37 + part]}
    benchmark = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    rows = [(k, f"{prose(610 + k, 30)} {damaged(draw, c, 3)} {prose(620 + k, 30)}") for k, c in cuts.items()]
    rows += [(10 + k, f"{prose(630 + k, 30)} {t} {prose(640 + k, 30)}") for k, t in texts.items()]
    rows += [(20, prose(650, 200))]
    found = dec.find_passages(make_docs(rows), benchmark).collect()
    pairs = {(k, k) for k in cuts} | {(10 + k, k) for k in texts}
    assert {(r["doc_id"], r["item_id"]) for r in found} == pairs
    # A whole item is not reported again in parts.
    assert sum(r["doc_id"] == 11 for r in found) == 1
    assert [r["doc_id"] for r in dec.without_contaminated(make_docs(rows), benchmark).collect()] == [20]


def test_items_without_an_id_and_short_ones(spark, make_docs):
    one, two = prose(700, 30), prose(701, 30)
    bench = [(None, one), (None, two), (9, "Two  Words"), (-3, "x7"), (None, "é"), (8, "words, two"), (7, " \n")]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    filler = "Filler."
    texts = {
        1: f"{filler} {one} {filler}",
        2: f"{filler} {two} {one}",
        3: "(two\n words) and twowords, two wordsmith, two words",
        4: "X7 x77 ax7 x7.",
        5: "café",
        6: "é",
        7: "two",
        8: "words",
        9: "",
        10: f"{filler} x7x",
    }
    docs = make_docs(list(texts.items())).coalesce(1)
    found = {(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in dec.find_passages(docs, benchmark).collect()}
    short = {(3, 9, 1, 11), (3, 9, 42, 51), (4, -3, 0, 2), (4, -3, 11, 13), (6, None, 0, 1)}
    assert short <= found
    assert sorted(r[0] for r in found - short) == [1, 2, 2] and {r[1] for r in found - short} == {None}
    kept = dec.without_contaminated(docs, benchmark).collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(3, 11))


def test_frames(spark, make_docs, odd_rows):
    item = prose(400, 20)
    bench = [(1, item), (1, item), (2, None), (3, "short"), (4, ""), (None, prose(401, 20)), (6, odd_rows[0][1])]
    benchmark = spark.createDataFrame(bench, "item_id long, text string").selectExpr("*", "'x' AS doc_id")
    rows = [*odd_rows, (50, "Before.  " + item.upper().replace(" ", "\n") + " after"), (51, item + " " + item)]
    docs = make_docs(rows)
    found = dec.find_passages(docs, benchmark).collect()
    assert sorted({r["doc_id"] for r in found if r["item_id"] == 1}) == [50, 51]
    assert sum(r["doc_id"] == 51 for r in found) == 2
    whole = next(r for r in found if r["doc_id"] == 50)
    assert plain(dict(rows)[50][whole["start"] : whole["end"]]) == plain(item)
    assert {r["doc_id"] for r in found if r["item_id"] == 6} == {3, 7, 13, None}
    kept = dec.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    left = {(r["doc_id"], r["text"]) for r in kept.collect()}
    bad = {odd_rows[0][1], odd_rows[-1][1], rows[-1][1], rows[-2][1]}
    assert left == {r for r in rows if r[1] not in bad}


def test_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(dec, "BLOCK_CHARS", 200)
    items = [(k, prose(500 + k, 20)) for k in range(9)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs([(k, prose(k, 30) + " " + t) for k, t in items])
    found = dec.find_passages(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, k) for k, _ in items}


def test_empty(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dec.find_passages(make_docs([(1, "text")]), none).collect() == []
    some = spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")
    assert dec.find_passages(make_docs([]), some).collect() == []
    assert dec.without_contaminated(make_docs([]), some).collect() == []


@pytest.mark.parametrize("free", [True, False])
def test_alignment_outside_the_text(free):
    codes = np.arange(10, dtype=np.uint32)
    low, high = np.array([0]), np.array([10])
    cost, _ = dec.align([codes[:4]], codes, np.array([-6]), [5], low, high, free)
    assert cost[0] >= 4


def test_query(spark, sf_dir, documents):
    import duckdb

    from telltale.llm.queries import registered

    bench = duckdb.connect().execute(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    found = registered()["op4_decontamination"](spark, sf_dir).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    exact = {(i, k) for k, b in bench for i, t in documents if plain(b) in plain(t or "")}
    assert exact and exact <= pairs
    texts, items = dict(documents), dict(bench)
    for i, k in pairs - exact:
        assert fewest_edits(plain(items[k])[: dec.PASSAGE], plain(texts[i])) <= dec.EDIT_RATE * dec.PASSAGE
