import os
import sys
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from tests_support import prose  # noqa: E402

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, "
    "simhash string, ids string, n_words string, anchor string, tie string, first string"
)


@pytest.fixture
def tokenizer():
    return TOKENIZER


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) with columns whose names the operators use inside."""

    def make(rows):
        full = [
            (i, t, "en", "s", len(t or ""), "a", "b", "c", "d", "e", "f", "g") for i, t in rows
        ]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd_rows():
    """NULLs, empty and blank texts, a very long one, ties, repeated rows and strange characters."""
    long = prose(1, 30_000)
    same = prose(2, 120)
    return [
        (7, same),
        (3, same),
        (3, same),
        (None, same),
        (None, "only without an id"),
        (4, None),
        (5, ""),
        (6, " \t\n\r\x0b\x0c "),
        (8, long),
        (9, "x" * 40_000),
        (10, "a " * 500),
        (11, "Ünïcödé    漢字 \U0001f600 \U0001df06 <|endoftext|>  two  spaces "),
        (12, "A B C"),
        (12, "another text with the same id"),
        (13, prose(3, 200) + " " + same),
    ]


@pytest.fixture(scope="session")
def sf_dir():
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("test tables absent")
    return path


@pytest.fixture(scope="session")
def documents(sf_dir):
    import duckdb

    found = duckdb.connect().execute(
        f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id"
    )
    return found.fetchall()
