"""Queries with an SQL counterpart, row for row."""

import glob
import os

import duckdb
import pytest

from telltale.llm.oracle import statements
from telltale.llm.queries import registered


@pytest.mark.parametrize("name", sorted(statements()))
def test_query(spark, sf_dir, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    frame = registered()[name](spark, sf_dir)
    found = sorted(map(repr, map(tuple, frame.collect())))
    columns = ", ".join(frame.columns)
    expected = duck.execute(f"SELECT {columns} FROM ({statements()[name]})").fetchall()
    assert found == sorted(map(repr, expected)) and found


def test_every_operator_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in registered()}
    assert numbers == set(range(1, 14))
