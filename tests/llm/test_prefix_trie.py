import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from telltale.llm import prefix_trie
from telltale.llm.prefix_trie import list_ranks, ordered_turns, shared_heads

COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


def brute(rows):
    """Nodes by plain dictionaries of tuples."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            order = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[conv].append((turn is not None, turn or 0, role, order, text))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in sorted(whole.items()):
        ends[turns].append(str(c))
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, held in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(held) - 1) * words
    return [
        (
            min(held), len(k), min(members[k[:-1]]) if k else None, len(held), kids[k], leaves[k], saved[k],
            hashlib.sha256(",".join(ends[k]).encode()).hexdigest(),
        )
        for k, held in members.items()
    ]


def same(found, expected):
    def order(row):
        return tuple((v is not None, v) for v in row)

    return sorted(found, key=order) == sorted(expected, key=order)


def trie(frame, short=prefix_trie.SHORT_LIST):
    found = prefix_trie.prefix_trie(*shared_heads(ordered_turns(frame)), short=short)
    return [tuple(r) for r in found.select(*COLUMNS).collect()]


def brute_rows(frame):
    return [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]


@pytest.fixture
def talks(spark):
    def make(rows):
        # Names that the operator uses inside, and one that differs in its case only.
        full = [(*r, "a", 1, "b", "c") for r in rows]
        schema = (
            "conv_id long, turn long, role string, text string, key string, idx long, Text string, words string"
        )
        return spark.createDataFrame(full, schema)

    return make


ODD = [
    (None, 0, "user", "without a conversation"),
    (0, 0, "user", "hello there"),
    (0, 1, "bot", " \t\n"),
    (0, None, None, None),
    (1, 5, "user", "hello there"),
    (1, 5, "user", "hello there"),
    (1, 5, "user", "Hello there"),
    (1, 6, "bot", ""),
    (2, 1, "user", "x" * 50_000),
    (3, 1, "a", "bc"),
    (4, 1, "ab", "c"),
    (5, 0, "user", "only"),
    (23, 0, "user", "no first one of the family"),
    (-7, 0, "user", "négatif 漢字\x0bx"),
    (-27, 0, None, "négatif"),
]


def test_odd_rows(talks):
    assert same(trie(talks(ODD)), brute(ODD))


def test_empty(talks):
    assert trie(talks([])) == []


def test_conversations_without_turns_of_their_own(talks):
    rows = [(c, 0, "user", "a b") for c in (21, 22, 23, 24, 25, 26, 27)]
    found = trie(talks(rows))
    assert same(found, brute(rows))
    assert any(r[1] == 0 for r in found)


@pytest.mark.parametrize("short", [4, 64, 10_000])
def test_a_hot_start_and_a_long_conversation(talks, monkeypatch, short):
    """A third of the rows is one conversation, a third starts alike."""
    monkeypatch.setattr("telltale.llm.ordering.ROWS_PER_PART", 50)
    monkeypatch.setattr("telltale.llm.ordering.ROWS_PER_BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "IDS_PER_TEXT", 8)
    draw = random.Random(5)
    rows = [(40, i, "user", draw.choice(["a", "b c"])) for i in range(150)]
    rows += [(c, i, "user", "the same") for c in range(100, 175) for i in range(2)]
    rows += [(c, i, "user", draw.choice("abc")) for c in range(200, 230) for i in range(draw.randint(1, 6))]
    draw.shuffle(rows)
    assert same(trie(talks(rows), short), brute(rows))


def test_list_ranks(spark):
    draw = random.Random(2)
    order = draw.sample(range(10_000), 700)
    links = list(zip(order, [*order[1:], None], strict=True))
    draw.shuffle(links)
    frame = spark.createDataFrame(links, "arc long, next long")
    for short in (1, 30, 10_000):
        found = {r["arc"]: r["place"] for r in list_ranks(frame, short).collect()}
        assert found == {arc: i for i, arc in enumerate(order)}


def test_query(spark, sf_dir):
    from telltale.llm.queries import registered

    found = registered()["op11_prefix_trie"](spark, sf_dir)
    rows = brute_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    assert same([tuple(r) for r in found.select(*COLUMNS).collect()], brute(rows))
