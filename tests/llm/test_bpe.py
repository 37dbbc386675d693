import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from telltale.llm import bpe
from tests_support import prose


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def spec():
    import public_tokenizers

    return bpe.tokenizer_spec(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder(spec):
    return bpe.Encoder(bpe.Vocabulary(spec))


def odd_texts():
    draw = random.Random(3)
    letters = "ab 's\n\t  \r\x0b\x1c\x85\xa0 ᠎​漢字é́ñ123!?\U0001f600"
    yield from ["", " ", "  ", "a  b", " a", "a ", " \n x", "a" * 3000, "<|endoftext|>"]
    yield from ["a <|endoftext|> b", "x<|endoftext|>y", "\x00 \x01", "՘ \U00010940"]
    for _ in range(1500):
        yield "".join(draw.choice(letters) for _ in range(draw.randint(0, 40)))
    for _ in range(1500):
        points = [draw.choice((draw.randint(0, 0x2FFF), draw.randint(0xE000, 0x1FFFF))) for _ in range(12)]
        yield "".join(map(chr, points))


def test_every_token_is_its_own_encoding(encoder):
    """The automaton holds every token that merges make, and no other."""
    known = set(encoder._shorter)
    assert known == set(encoder.vocabulary.ids.values())


def test_same_as_library(encoder, library):
    texts = list(odd_texts())
    for text, expected in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False)):
        assert encoder.encode(text) == expected.ids, text


def test_pieces_without_shortcuts(encoder, library):
    """Whole texts as one piece: long runs of letters need steps back."""
    draw = random.Random(9)
    for _ in range(300):
        piece = "".join(draw.choices("abcdehilnorst", k=draw.randint(1, 60)))
        assert list(encoder.encode_piece(piece.encode())) == library.encode(piece).ids


def test_library_units(spec, library):
    texts = list(odd_texts())
    units = bpe.LibraryUnits(spec)
    texts += [prose(k, 60) for k in range(20)] + ["\nA b!!\nC ", " x\ny"]
    for _ in range(2):
        found = units.many(pa.array(texts))
        for ids, expected in zip(found, library.encode_batch_fast(texts, add_special_tokens=False)):
            assert ids.tolist() == expected.ids
    assert [x.tolist() for x in units.many(pa.array(["zz", None, "", "a b"]).slice(1))] == [
        [], [], library.encode("a b").ids,
    ]
    assert units.many(pa.array([], pa.string())) == []


def test_decoding(encoder, library):
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.vocabulary.decode(np.array(ids, "<u4")).decode() == library.decode(
            ids, skip_special_tokens=False
        )


def test_frames(make_docs, odd_rows, tokenizer, library):
    docs = make_docs(odd_rows)
    encoded = bpe.encode_texts(docs, tokenizer)
    assert set(encoded.columns) == set(docs.columns)
    for row in bpe.decode_ids(encoded, tokenizer).collect():
        text = row["text"] or ""
        assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert row["decoded"] == text and row["score"] == "a"
    both = bpe.encode_texts(docs, tokenizer, into="score", decoded="tie")
    assert set(both.columns) == set(docs.columns)
    assert all(r["tie"] == (r["text"] or "") and len(r["score"]) % 4 == 0 for r in both.collect())
    assert bpe.encode_texts(make_docs([]), tokenizer).collect() == []


def test_query(spark, sf_dir, documents, library):
    from telltale.llm.queries import registered

    found = {r["doc_id"]: r for r in registered()["op3_bpe"](spark, sf_dir).collect()}
    assert len(found) == len(documents)
    for i, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw = struct.pack(f"<{len(ids)}I", *ids)
        text = library.decode(ids, skip_special_tokens=False)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
