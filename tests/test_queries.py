"""Every registered query against its SQL counterpart, and the driver contract."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from telltale.plans.oracle import statements
from telltale.plans.queries import registered

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sorted(found):
    return sorted((tuple(r) for r in found), key=lambda r: [(v is not None, v) for v in r])


def test_every_query_has_a_counterpart():
    assert set(registered()) == set(statements())
    assert set(registered()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    other = duck.sql(contract.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(other.columns)
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE"}
    ours = {n: kinds[t] for n, t in frame.dtypes}
    assert ours == dict(zip(other.columns, map(str, other.types)))
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = other.query("o", f"SELECT {picked} FROM o").fetchall()
    found = _sorted(frame.select(*columns).collect())
    assert found == _sorted(expected)
    assert found


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[0] == "messageid" and frame.count() > 0


def test_table_in_many_files(spark, rows, tmp_path):
    """On a cluster a table is a folder of files; batch and stream read both."""
    table = spark.read.parquet(f"{SF_DIR}/events.parquet")
    table.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("alerts_detail", "alerts_stream", "history_stream", "window_fill_history"):
        query = contract.queries()[name]
        assert rows(query(spark, str(tmp_path))) == rows(query(spark, SF_DIR))
