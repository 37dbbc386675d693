import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from telltale.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
        "spark.log.level": "ERROR",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("telltale-tests", **settings)
    yield session
    session.stop()


@pytest.fixture
def readings(spark):
    """Make a frame of readings from (messageid, time, name, metrics, value) rows."""

    def make(*rows):
        frame = spark.createDataFrame(
            list(rows), "messageid string, t string, name string, metrics string, value string"
        )
        return frame.selectExpr(
            "messageid", "CAST(t AS timestamp) AS messagedate", "name", "metrics", "value"
        )

    return make


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, NULLs first."""

    def take(frame, *columns):
        if columns:
            frame = frame.select(*columns)
        found = [tuple(r) for r in frame.collect()]
        return sorted(found, key=lambda r: [(v is not None, v) for v in r])

    return take


def physical_plan(frame) -> str:
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@pytest.fixture
def plan():
    return physical_plan
