import re

import numpy as np
import pyarrow as pa
import pytest

from telltale.llm import word_digests
from telltale.llm.word_digests import Words, run_digests
from tests_support import prose, thue_morse

TEXTS = [
    "", " ", "a", " a b ", "b a", None, "a\x0bb\tc\r\nd\x0ce", "Ünï\xa0x 漢 \x1c y", "A a",
    "ends", "starts", "x" * 5000, prose(3, 300),
]


@pytest.mark.parametrize("block", [1 << 21, 7])
@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("kind", [pa.string(), pa.binary()])
def test_words(monkeypatch, block, small, kind):
    monkeypatch.setattr(word_digests, "BLOCK", block)
    array = pa.array(["cut off", *TEXTS], pa.string()).cast(kind).slice(1)
    found = Words(array, small)
    expected = [
        (k, w.encode()) for k, t in enumerate(TEXTS) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")
    ]
    got = [
        (int(k), found.bytes[a:b].tobytes())
        for k, a, b in zip(found.owner, found.starts, found.ends)
    ]
    assert got == expected and found.n_texts == len(TEXTS)
    plain = [w.lower() if small else w for _, w in expected]
    by_word = {}
    for w, d in zip(plain, found.digests.tolist()):
        assert by_word.setdefault(w, d) == d
    assert len(set(by_word.values())) == len(by_word)


def test_digests_do_not_depend_on_the_place():
    a = Words(pa.array(["one two three"])).digests
    b = Words(pa.array(["zero one", "two three " + "x " * 1000])).digests
    assert np.array_equal(a, b[1:4])


def test_words_in_a_row():
    found = Words(pa.array([" a  b\n", "c d "]))
    assert found.joined(0, 2) == b"a b" and found.joined(2, 4) == b"c d"


def test_no_texts():
    assert len(Words(pa.array([], pa.string())).digests) == 0
    assert len(Words(pa.array([None], pa.string())).digests) == 0


def test_words_in_a_pattern_differ():
    found = Words(pa.array([thue_morse(1024), thue_morse(1024, "ba"), thue_morse(4096), thue_morse(4096, "ba")]))
    assert len(set(found.digests.tolist())) == 4


def test_runs_in_a_pattern_differ():
    values = {"a": 0x0123456789ABCDEF, "b": 0xFEDCBA9876543210}
    flat = np.array([values[c] for c in thue_morse(1024) + thue_morse(1024, "ba")], np.uint64)
    a, b = run_digests(flat, np.array([0, 1024]), np.array([1024, 2048]))
    assert a != b
    again = run_digests(np.r_[flat[:7], flat], np.array([7, 1031]), np.array([1031, 2055]))
    assert again.tolist() == [a, b]
