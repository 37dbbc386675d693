from collections import Counter

import pytest

from telltale.llm import quality_rules as rules
from tests_support import prose


def slow_facts(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if many[r] > 1 for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_facts(make_docs, odd_rows):
    more = [(60, "a b c a b c x"), (61, "a b c d a b c\n\n x \n x \n x "), (62, "#|<>\n\n&"), (63, "a a a a")]
    rows = [*odd_rows, *more]
    docs = make_docs(rows).drop("n_words")
    for r in rules.text_facts(docs).collect():
        expected = slow_facts(r["text"])
        assert {k: r[k] for k in expected} == expected


def test_thresholds_follow_the_group(spark, make_docs):
    """A group whose texts are full of symbols keeps them; in another they stand out."""
    calm = [(k, prose(k, 60)) for k in range(30)]
    loud = [(100 + k, prose(k, 60).replace(" ", " # ")) for k in range(30)]
    odd = [(500, prose(500, 60).replace(" ", " # "))]
    calm_docs = make_docs([*calm, *odd])
    loud_docs = make_docs(loud).withColumn("source", rules.F.lit("loud"))
    docs = calm_docs.unionByName(loud_docs)
    before, rules.MIN_DOCS = rules.MIN_DOCS, 20
    try:
        kept = {r["doc_id"]: r["kept"] for r in rules.judge(docs).collect()}
    finally:
        rules.MIN_DOCS = before
    assert all(kept[i] for i, _ in [*calm, *loud]) and not kept[500]


@pytest.mark.parametrize("share", [30, 40])
def test_junk_in_a_large_part_of_a_group(make_docs, monkeypatch, share):
    """Junk that is a quartile of its source does not make room for itself."""
    monkeypatch.setattr(rules, "MIN_DOCS", 20)
    good = [(k, prose(k, 60)) for k in range(100 - share)]
    junk = [(100 + k, prose(k, 60).replace(" ", " ## ")) for k in range(share // 2)]
    junk += [(200 + k, prose(k, 60).replace(" ", " |||||| ")) for k in range(share // 2)]
    kept = {r["doc_id"]: r["kept"] for r in rules.judge(make_docs([*good, *junk])).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk)


def test_merged_sketches_are_the_sketch_of_the_whole(spark, make_docs):
    rows = [(k, prose(k, 20 + 7 * k)) for k in range(40)]
    facts = rules.text_facts(make_docs(rows).drop("n_words"))
    facts = facts.withColumn("source", rules.F.expr("string(doc_id % 3)"))
    narrow = rules.merged(rules.sketch(facts, "lang", "source"), "lang")
    whole = rules.sketch(facts, "lang")
    key = ["lang", "metric", "low", "n"]
    assert sorted(map(tuple, narrow.select(*key).collect())) == sorted(map(tuple, whole.select(*key).collect()))
    for r in whole.collect():
        assert r["low"] < 1 << rules.DIGITS or r["low"] % 2 == 0


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows).selectExpr("doc_id", "text", "nullif(lang, 'en') AS lang", "source", "score")
    found = rules.judge(docs).collect()
    assert len(found) == len(odd_rows)
    assert all(r["lang"] == "" for r in found)
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert rules.judge(make_docs([])).collect() == []


def test_no_python_in_the_plan(spark, sf_dir, plan):
    from telltale.llm.queries import registered

    text = plan(registered()["op7_quality_rules"](spark, sf_dir))
    assert "Python" not in text and "Arrow" not in text
