import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from telltale.llm import kneser_ney
from telltale.session import run_dir
from tests_support import prose


def tokens_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), " end"]


class Slow:
    """The model by dictionaries."""

    def __init__(self, texts):
        self.words, self.pairs, self.seen = Counter(), Counter(), Counter()
        for text in texts:
            before = " begin"
            for token in tokens_of(text):
                self.words[token] += 1
                self.pairs[before, token] += 1
                self.seen[before] += 1
                before = token
        self.behind = Counter(w for _, w in self.pairs)
        self.d, self.e = (self.off(c) for c in (self.pairs, self.behind))
        self.left = defaultdict(float)
        for (before, _), n in self.pairs.items():
            self.left[before] += self.d[min(n, 3)]

    @staticmethod
    def off(counts):
        n = [sum(1 for c in counts.values() if c == k) for k in range(5)]
        return (0, *kneser_ney.discounts(*n[1:]))

    def low(self, word):
        n, total, v = self.behind[word], len(self.pairs), len(self.words)
        if not total:
            return 1 / (v + 1)
        spare = sum(self.e[min(c, 3)] for c in self.behind.values()) / total
        return max(n - self.e[min(n, 3)], 0) / total + spare / (v + 1)

    def p(self, before, word):
        seen = self.seen[before]
        if not seen:
            return self.low(word)
        n = self.pairs[before, word]
        return max(n - self.d[min(n, 3)], 0) / seen + self.left[before] / seen * self.low(word)

    def score(self, text):
        total, before = 0.0, " begin"
        for token in tokens_of(text):
            total += math.log10(self.p(before, token))
            before = token
        return total

    def base(self, text):
        whole = sum(self.words.values()) + len(self.words) + 1
        return sum(math.log10((self.words[t] + 1) / whole) for t in tokens_of(text))


@pytest.mark.parametrize("shards", [1, 5])
def test_against_dictionaries(spark, make_docs, odd_rows, shards):
    more = [(100 + k, prose(20 + k % 7, 150)) for k in range(12)]
    train = [*odd_rows, *more]
    model = kneser_ney.train(make_docs(train), run_dir(spark, "model"), shards)
    slow = Slow([t for _, t in train])
    assert model.n_tokens == sum(slow.words.values())
    assert (model.n_words, model.n_pairs) == (len(slow.words), len(slow.pairs))
    asked = make_docs([*odd_rows, (200, "never seen words at all"), (201, prose(99, 80))])
    found = kneser_ney.score_texts(asked, model)
    assert "anchor" in found.columns and found.columns.count("score") == 1
    for r in found.collect():
        own = tokens_of(r["text"])
        assert r["n_tokens"] == len(own)
        assert r["n_known"] == sum(t in slow.words for t in own)
        assert r["base_score"] == pytest.approx(slow.base(r["text"]), rel=1e-9)
        assert r["score"] == pytest.approx(slow.score(r["text"]), rel=1e-6)


def test_probabilities_sum_to_one(spark, make_docs):
    slow = Slow([prose(k, 60) for k in range(5)])
    for before in ["never seen", " begin", *list(slow.words)[:5]]:
        known = sum(slow.p(before, w) for w in slow.words)
        assert known + slow.p(before, "unknown") == pytest.approx(1)


def test_empty(spark, make_docs):
    model = kneser_ney.train(make_docs([]), run_dir(spark, "model"), 2)
    assert (model.n_tokens, model.n_words) == (0, 0)
    found = kneser_ney.score_texts(make_docs([(1, "a b"), (2, None)]), model).collect()
    assert [r["score"] for r in found] == [0.0, 0.0]
    assert kneser_ney.score_texts(make_docs([]), model).collect() == []


def test_query(spark, sf_dir, documents):
    from telltale.llm.queries import registered

    held_out = {i for i, _ in documents if zlib.crc32(str(i).encode()) % 7 == 2}
    slow = Slow([t for i, t in documents if i not in held_out])
    found = {r["doc_id"]: r for r in registered()["op2_lm_scoring"](spark, sf_dir).collect()}
    assert len(found) == len(documents)
    better = 0
    for i, text in documents:
        assert found[i]["held_out"] == (i in held_out)
        assert found[i]["train_tokens"] == sum(slow.words.values())
        assert found[i]["score"] == pytest.approx(slow.score(text), rel=1e-6)
        assert found[i]["base_score"] == pytest.approx(slow.base(text), rel=1e-9)
        better += i in held_out and found[i]["score"] > found[i]["base_score"]
    assert better > 0.9 * len(held_out)
