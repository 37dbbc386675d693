import random

import pytest
from pyspark.sql import functions as F

from telltale.operators.cells import column_mapping, latest_cells, wide_cells
from telltale.fixed import CAR_WIDE_COLUMNS
from telltale.schema import POSITION
from telltale.sinks.cellstore import fold, latest_stored, lookup
from telltale.sinks.commits import committed
from telltale.sinks.tables import packed_batches, write_batch


@pytest.fixture
def puts(spark):
    """Puts of few cells in batches, with ties, out of order, and some without an address."""
    draw = random.Random(4)

    def make(batch, n=60):
        rows = [
            (
                draw.choice(["a-1", "a-2", "ab-1", "b-1", "c-9"]), draw.choice(["car", "driver"]), draw.choice("pq"),
                draw.choice([None, str(draw.randint(0, 99))]), draw.randint(0, 3), draw.randint(0, 1) + batch, i, f"{draw.randint(0, 9)}", None,
            )
            for i in range(n)
        ]
        rows += [(None, "car", "p", "1", 9, 9, 9, "x", None), ("a-1", None, "p", "1", 9, 9, 9, "x", None)]
        frame = spark.createDataFrame(rows, "row_key string, family string, qualifier string, value string, version int, arrival long, place long, messageid string, position string")
        day = F.lit("2018-06-29").cast("timestamp") + F.make_dt_interval(F.col("version"))
        return frame.withColumn("version", day).withColumn("position", F.lit(None).cast(POSITION))

    return make


def addressed(frame):
    return frame.dropna("any", subset=["row_key", "family", "qualifier"])


def test_store_and_tail_equal_the_whole_log(spark, puts, rows, plan, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    for k in range(7):
        write_batch(puts(k), log, f"q-{k}", "version")
        whole = latest_cells(addressed(committed(spark, log)))
        assert rows(latest_stored(spark, log, store)) == rows(whole)
        found = lookup(spark, log, store, prefix="a-")
        assert rows(found) == rows(whole.where("row_key LIKE 'a-%'"))
        if k < 5:
            fold(spark, log, store, fan=2, buckets=4)
            assert rows(latest_stored(spark, log, store)) == rows(whole)
    levels = {r["tier"] for r in packed_batches(spark, store).select("tier").distinct().collect()}
    assert len(levels) == 2 and max(levels) == 2
    assert fold(spark, log, store, fan=2) and not fold(spark, log, store, fan=2)


def test_the_largest_run_is_not_shuffled(spark, puts, plan, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    write_batch(puts(0), log, "q-0", "version")
    fold(spark, log, store, buckets=4)
    write_batch(puts(1), log, "q-1", "version")
    lines = plan(latest_stored(spark, log, store))
    assert "SelectedBucketsCount: 4 out of 4" in lines
    tree = lines.split("\n\n")[0]
    scans = [i for i, x in enumerate(tree.splitlines()) if "Scan parquet spark_catalog" in x]
    assert len(scans) == 1
    # From the scan of the run up to the join there is a sort and no exchange.
    above = tree.splitlines()[: scans[0]]
    depth = tree.splitlines()[scans[0]].index("Scan")
    chain = []
    for line in reversed(above):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            chain.append(line.strip(" :+-").split(" ")[0])
            depth = at
    assert "SortMergeJoin" in chain and "Exchange" not in chain[: chain.index("SortMergeJoin")]


def test_lookups_are_pushed_to_the_files(spark, puts, plan, rows, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    write_batch(puts(0), log, "q-0", "version")
    fold(spark, log, store, buckets=4)
    found = lookup(spark, log, store, keys=["a-1", "c-9"])
    assert rows(found) == rows(latest_cells(addressed(committed(spark, log))).where("row_key IN ('a-1', 'c-9')"))
    assert "In(row_key, [a-1,c-9])" in plan(found)
    assert "StringStartsWith(row_key,a)" in plan(lookup(spark, log, store, prefix="a"))
    assert lookup(spark, log, store, keys=["none"]).count() == 0
    with pytest.raises(ValueError):
        lookup(spark, log, store)


def test_a_broken_fold_is_not_read(spark, puts, rows, tmp_path, monkeypatch):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    write_batch(puts(0), log, "q-0", "version")
    expected = rows(latest_cells(addressed(committed(spark, log))))

    def broken(*_, **__):
        raise RuntimeError("no manifest")

    monkeypatch.setattr("telltale.sinks.cellstore.name_pack", broken)
    with pytest.raises(RuntimeError):
        fold(spark, log, store, buckets=4)
    monkeypatch.undo()
    assert rows(latest_stored(spark, log, store)) == expected
    fold(spark, log, store)
    assert rows(latest_stored(spark, log, store)) == expected


MAPPING = """
    driver:driver-blood-pressure,
    car:tire-pressure, car:ultrasonic-sensor-front,
    car:ultrasonic-sensor-back, car:current-speed,
    car:current-location-long, car:current-location-lat,
    car:value"""


def test_column_mapping(spark, puts, rows):
    names = [n for n, _, _ in CAR_WIDE_COLUMNS]
    assert column_mapping(["id", *names], MAPPING) == list(CAR_WIDE_COLUMNS)
    assert column_mapping(["a", "id", "b"], "f:x, :key, f:y:z") == [("a", "f", "x"), ("b", "f", "y:z")]
    for names, text in ((["id", "a"], "f:x, f:y, f:z"), (["a"], "fx"), (["a"], "f:")):
        with pytest.raises(ValueError):
            column_mapping(names, text)
    wide = wide_cells(puts(0), column_mapping(["key", "p"], "car:p"))
    assert wide.columns == ["id", "p"] and wide.count() == 6
