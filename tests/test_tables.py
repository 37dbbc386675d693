import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from telltale.__main__ import kafka_settings, parser
from telltale.operators.cells import latest_cells, to_cells
from telltale.operators.decode import decode, placed
from telltale.operators.serving import mart_scan
from telltale.operators.windows import spine_for, window_fill
from telltale.schema import READING, READING_FIELDS, RULE
from telltale.session import run_dir, shared_dir
from telltale.sinks.catalog import refresh, register
from telltale.sinks.commits import (
    Attempt,
    committed,
    compact_log,
    effective,
    place_of,
    sweep,
)
from telltale.sinks.exports import (
    kafka_sink_options,
    publish,
    publish_stream,
    read_quoted_csv,
    write_quoted_csv,
)
from telltale.sinks.tables import (
    append_by_date,
    append_table,
    create_table,
    drop_table,
    add_to,
    insert_rows,
    merge_packs,
    pack_batches,
    packed_batches,
    prune_mart,
    read_mart,
    read_packed,
    vacuum,
    windows_won,
    write_batch,
    write_mart,
)
from telltale.sources.readings import (
    MESSAGES_PER_BATCH,
    history,
    kafka_messages,
    kafka_options,
    message_values,
)

AS_OF = date(2018, 6, 30)


@pytest.fixture
def made(readings):
    return readings(
        ("a", "2018-06-28 23:59:59", "car", "speed", "1"),
        ("b", "2018-06-29 00:03:52", "car", "speed", "2"),
        ("c", "2018-06-30 12:00:00", "car", "heat", None),
    )


def test_appends_match_columns_by_name(spark, made, rows, tmp_path):
    append_table(made, "appended", str(tmp_path / "t"))
    append_table(made.select(*reversed(READING_FIELDS)), "appended", str(tmp_path / "t"))
    assert rows(spark.table("appended"), *READING_FIELDS) == sorted(
        rows(made) * 2, key=lambda r: [(v is not None, v) for v in r]
    )
    drop_table(spark, "appended")
    drop_table(spark, "appended")  # a missing table is no error


def test_table_can_be_created_anew(spark, tmp_path):
    create_table(spark, "limits", RULE, str(tmp_path / "limits"))
    insert_rows(spark, "limits", [("speed", "130", "50", "ltgt"), ("heat", "9", "1", "gt")])
    insert_rows(spark, "limits", [("x", "1", "1", "eq")])
    assert spark.table("limits").count() == 3
    create_table(spark, "limits", READING, str(tmp_path / "other"))
    assert spark.table("limits").columns == READING.names
    drop_table(spark, "limits")


def test_history_is_partitioned_by_day(spark, made, rows, plan, tmp_path):
    path = str(tmp_path / "h")
    append_by_date(made, path)
    append_by_date(made.limit(0), path)
    assert sorted(p.name for p in (tmp_path / "h").glob("batch=*/event_date=*")) == [
        "event_date=2018-06-28",
        "event_date=2018-06-29",
        "event_date=2018-06-30",
    ]
    assert rows(history(spark, path), *READING_FIELDS) == rows(made)
    assert dict(history(spark, path).dtypes)["event_date"] == "date"
    some = history(spark, path, date(2018, 6, 29), date(2018, 6, 29))
    assert rows(some, "messageid") == [("b",)]
    # One day is listed at all.
    assert "event_date=2018-06-29" in plan(some) and "event_date=2018-06-28" not in plan(some)


def test_a_repeated_batch_replaces_itself_only(spark, made, rows, tmp_path):
    path = str(tmp_path / "b")
    write_batch(made, path, "q-0", "messagedate")
    write_batch(made, path, "q-1", "messagedate")
    write_batch(made, path, "q-1", "messagedate")
    write_batch(made, path, "other-0", "messagedate")
    assert committed(spark, path).count() == 9
    assert rows(history(spark, path).distinct(), *READING_FIELDS) == rows(made)


def test_mart_run_can_be_repeated(spark, made, rows, tmp_path):
    path = str(tmp_path / "m")
    for _ in range(2):
        write_mart(window_fill(made, spine_for(AS_OF)), path, AS_OF)
    stored = spark.read.parquet(path)
    assert stored.count() == 1001 - 1  # 998 empty windows, two readings
    assert stored.where("messagedate != datewindows").isEmpty()
    scan = mart_scan(stored)
    first = rows(scan)
    assert scan.columns == ["messagedate", "metrics", "name", "value"]
    assert ("2018-06-29 00:00:00", "speed", "car", "2") in rows(scan)

    before = date(2018, 6, 29)
    write_mart(window_fill(made, spine_for(before)), path, before)
    after = spark.read.parquet(path)
    assert after.count() == 2000
    # The windows of both runs are those of the later one.
    found = rows(mart_scan(after))
    assert len(found) == 1000 + 288 and set(first) <= set(found)
    assert len({r[0] for r in found}) == len(found)


def test_a_later_run_fills_a_window(spark, made, rows, tmp_path):
    path = str(tmp_path / "m")
    write_mart(window_fill(made.where("messageid <> 'b'"), spine_for(AS_OF)), path, AS_OF)
    later = date(2018, 7, 1)
    again = made.withColumn("messagedate", F.col("messagedate") + F.expr("INTERVAL 1 DAY"))
    write_mart(window_fill(again, spine_for(later)), path, later)
    found = rows(mart_scan(spark.read.parquet(path)).where("messagedate LIKE '2018-06-30 00:00%'"))
    assert found == [("2018-06-30 00:00:00", "speed", "car", "2")]


def test_packs(spark, made, rows, tmp_path):
    """Many batches of a day become few files; late, new and broken ones change nothing."""
    live, archive = str(tmp_path / "l"), str(tmp_path / "a")
    for i in range(6):
        write_batch(made, live, f"q-{i}", "messagedate")
    assert rows(read_packed(spark, live, archive), *READING_FIELDS) == rows(
        history(spark, live), *READING_FIELDS
    )
    assert pack_batches(spark, live, archive, date(2018, 6, 29)) is not None
    assert pack_batches(spark, live, archive, date(2018, 6, 29)) is None
    packed = packed_batches(spark, archive)
    assert packed.count() == 12
    files = list((tmp_path / "a").glob("packs/pack=*/event_date=2018-06-28/*.parquet"))
    assert len(files) == 1

    write_batch(made, live, "late-0", "messagedate")
    expected = rows(history(spark, live), *READING_FIELDS)
    assert rows(read_packed(spark, live, archive), *READING_FIELDS) == expected
    assert pack_batches(spark, live, archive) is not None
    assert rows(read_packed(spark, live, archive), *READING_FIELDS) == expected
    day = read_packed(spark, live, archive, date(2018, 6, 29), date(2018, 6, 29))
    assert rows(day, "messageid") == [("b",)] * 7
    # A pack that the manifest does not name is not read.
    made.withColumn("event_date", F.lit(date(2018, 6, 29))).withColumn(
        "batch", F.lit("x")
    ).write.partitionBy("event_date").parquet(f"{archive}/packs/pack=half")
    assert rows(read_packed(spark, live, archive), *READING_FIELDS) == expected


def test_a_repeat_with_fewer_days_leaves_its_own_rows(spark, made, rows, tmp_path):
    path = str(tmp_path / "b")
    write_batch(made, path, "monday", "messagedate")
    write_batch(made.where("messageid = 'b'"), path, "monday", "messagedate")
    assert rows(history(spark, path), "messageid") == [("b",)]
    write_batch(made.limit(0), path, "monday", "messagedate")
    assert history(spark, path).count() == 0
    write_batch(made, path, "monday", "messagedate")
    assert history(spark, path).count() == 3


def test_an_attempt_counts_as_a_whole_or_not_at_all(spark, made, rows, tmp_path):
    one, two, log = (str(tmp_path / n) for n in ("one", "two", "log"))
    first = Attempt(spark, "x", log)
    add_to(first, made, one, "messagedate")
    add_to(first, made.select("name"), two)
    first.commit()
    broken = Attempt(spark, "x", log)
    add_to(broken, made.where("messageid = 'a'"), one, "messagedate")
    assert committed(spark, one).count() == committed(spark, two).count() == 3
    again = Attempt(spark, "x", log)
    add_to(again, made.where("messageid = 'a'"), one, "messagedate")
    again.commit()
    # The second table was not written this time, so it has nothing of the batch.
    assert rows(committed(spark, one), "messageid") == [("a",)]
    with pytest.raises(ValueError, match="no batch of this table"):
        committed(spark, two)
    nothing = Attempt(spark, "x", log)
    nothing.commit_nothing()
    with pytest.raises(ValueError, match="no batch of this table"):
        committed(spark, one)
    with pytest.raises(ValueError, match="its commits are in"):
        add_to(Attempt(spark, "y", str(tmp_path / "other")), made, one, "messagedate")


def test_a_table_may_get_more_columns(spark, made, rows, tmp_path):
    path = str(tmp_path / "b")
    write_batch(made.drop("value"), path, "q-0", "messagedate")
    write_batch(made.withColumn("unit", F.lit("km")), path, "q-1", "messagedate")
    found = committed(spark, path)
    assert set(found.columns) == {*READING_FIELDS, "unit", "batch", "event_date"}
    assert sorted(rows(found, "messageid", "unit"), key=str) == sorted(
        [(i, u) for i in "abc" for u in (None, "km")], key=str
    )


def test_rows_without_a_time_are_refused(spark, made, tmp_path):
    path = str(tmp_path / "b")
    untimed = made.withColumn("messagedate", F.lit(None).cast("timestamp"))
    with pytest.raises(ValueError, match="without a time"):
        write_batch(made.unionByName(untimed), path, "q-0", "messagedate")


def test_log_is_rewritten_and_unread_folders_go(spark, made, rows, tmp_path):
    path = str(tmp_path / "b")
    for k in range(4):
        write_batch(made, path, f"q-{k}", "messagedate")
        write_batch(made.where("messageid <> 'c'"), path, f"q-{k}", "messagedate")
    add_to(Attempt(spark, "broken"), made, path, "messagedate")
    before = rows(history(spark, path), *READING_FIELDS)
    log = place_of(spark, path).log
    assert len(effective(spark, log)) == 4
    assert compact_log(spark, log, grace=3600) == 0 and sweep(spark, path, grace=3600) == []
    assert len(sweep(spark, path, grace=0)) == 5
    assert compact_log(spark, log, grace=0) == 8
    assert len(list((tmp_path / "b" / "_commits").glob("commit=*"))) == 1
    assert rows(history(spark, path), *READING_FIELDS) == before
    # A batch that is repeated later still takes the place of the old one.
    write_batch(made.limit(0), path, "q-0", "messagedate")
    assert history(spark, path).count() == 6


def test_packed_live_days_are_not_scanned(spark, made, plan, tmp_path):
    live, archive = str(tmp_path / "l"), str(tmp_path / "a")
    write_batch(made, live, "q-0", "messagedate")
    pack_batches(spark, live, archive, date(2018, 6, 29))
    found = plan(read_packed(spark, live, archive))
    assert "event_date=2018-06-30" in found
    assert found.count("/l/batch=") == 1
    pack_batches(spark, live, archive)
    assert "/l/batch=" not in plan(read_packed(spark, live, archive))


def test_packs_are_merged_and_vacuumed(spark, made, rows, tmp_path):
    live, archive = str(tmp_path / "l"), str(tmp_path / "a")
    for k in range(9):
        write_batch(made.withColumn("value", F.lit(str(k))), live, f"q-{k}", "messagedate")
        pack_batches(spark, live, archive)
        if k % 2:
            merge_packs(spark, archive, fan=3)
    expected = sorted(rows(made.select("messageid")) * 9)
    found = read_packed(spark, live, archive)
    assert sorted(rows(found, "messageid")) == expected
    held = packed_batches(spark, archive)
    assert held.count() == 27 and held.select("event_date", "batch").distinct().count() == 27
    packs = held.select("pack").distinct().count()
    assert packs < 5
    write_batch(made, live, "late", "messagedate")
    add_to(Attempt(spark, "broken"), made, live, "messagedate")
    assert set(vacuum(spark, live, archive, grace=3600).values()) == {0}
    done = vacuum(spark, live, archive, grace=0)
    assert done["days"] == 27 and done["packs"] > 0
    assert [p.name[:11] for p in (tmp_path / "l").glob("batch=*")] == ["batch=late~"[:11]]
    assert len(list((tmp_path / "a" / "packs").glob("pack=*"))) == packs
    assert sorted(rows(read_packed(spark, live, archive), "messageid")) == sorted(expected + rows(made, "messageid"))
    # The live table is what is left of it; new batches go on as before.
    assert history(spark, live).count() == 3
    assert vacuum(spark, live, archive, grace=0)["days"] == 0
    pack_batches(spark, live, archive)
    assert sorted(rows(read_packed(spark, live, archive), "messageid")) == sorted(expected + rows(made, "messageid"))


def test_folder_names_with_quotes(spark, rows, tmp_path):
    create_table(spark, "quoted", RULE, str(tmp_path / "it's"))
    insert_rows(spark, "quoted", [("speed", "1", "1", "gt")])
    assert spark.table("quoted").count() == 1
    drop_table(spark, "quoted")


def test_quoted_csv(spark, rows, tmp_path):
    frame = spark.createDataFrame(
        [('{"k": 69}', 'O\'Brien "X"', 1), ("a,b", " blank ", 2), ("back\\slash", None, 3)],
        "a string, b string, n int",
    )
    path = str(tmp_path / "c")
    write_quoted_csv(frame.coalesce(1), path)
    assert rows(read_quoted_csv(spark, path, frame.schema)) == rows(frame)
    text = next((tmp_path / "c").glob("*.csv")).read_text().splitlines()
    assert text[0] == '"a","b","n"' and '"a,b"," blank ","2"' in text
    assert '"{""k"": 69}","O\'Brien ""X""","1"' in text


def test_quoted_csv_with_line_breaks(spark, rows, tmp_path):
    frame = spark.createDataFrame([("a\nb", 1)], "a string, n int")
    path = str(tmp_path / "c")
    write_quoted_csv(frame, path)
    assert rows(read_quoted_csv(spark, path, frame.schema, multiline=True)) == [("a\nb", 1)]


def test_kafka_options():
    assert kafka_options("h:9092", "t") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": str(MESSAGES_PER_BATCH),
    }
    more = kafka_options("h:9092", "t", "earliest", max_per_batch=5, min_partitions=64)
    assert more["maxOffsetsPerTrigger"] == "5" and more["minPartitions"] == "64"
    assert kafka_sink_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "topic": "t"}


class _Recorder:
    """Stands for a reader or writer and keeps what it was given."""

    def __init__(self):
        self.given = {}

    def format(self, name):
        self.given["format"] = name
        return self

    def options(self, **options):
        self.given.update(options)
        return self

    def option(self, name, value):
        self.given[name] = value
        return self

    def load(self):
        return self

    def save(self):
        return self

    start = save


def test_kafka_options_reach_the_reader(spark, monkeypatch):
    reader = _Recorder()
    monkeypatch.setattr(type(spark), "readStream", reader)
    monkeypatch.setattr("telltale.sources.readings.message_values", lambda records: records)
    job = ["speed", "--rules", "r", "--out", "o", "--checkpoint", "c", "--brokers", "h:1"]
    asked = ["--topic", "t", "--starting", "earliest", "--min-partitions", "9"]
    options = parser().parse_args([*job, *asked, "--max-per-batch", "77"])
    kafka_messages(spark, options.brokers, options.topic, **kafka_settings(options))
    assert reader.given == {
        "format": "kafka",
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "77",
        "minPartitions": "9",
    }


def test_kafka_options_reach_the_writer(made, monkeypatch):
    for name, send in (
        ("write", lambda: publish(made, "h:1", "t")),
        ("writeStream", lambda: publish_stream(made, "h:1", "t", "state")),
    ):
        writer = _Recorder()
        monkeypatch.setattr(type(made), name, writer)
        send()
        assert writer.given["format"] == "kafka" and writer.given["topic"] == "t"
        assert writer.given.get("checkpointLocation") == ("state" if name == "writeStream" else None)


def test_offset_of_a_message_is_kept(spark, rows):
    text = '{"name": "n", "messageid": "1", "messagedate": "20180629170000", "metrics": "m"}'
    records = spark.createDataFrame([(text, 7)], "value string, offset long")
    assert rows(placed(decode(message_values(records))), "messageid", "place") == [("1", 7)]


def test_kafka_source_needs_its_connector_only(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "h:9092", "t")


def test_shared_folder_is_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    assert run_dir(spark, "x").startswith(f"{named}/x-")
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_sweep_of_runs():
    day = date(2024, 1, 1)

    def run(k, first, last):
        return (day + timedelta(days=k), first, last)

    won = windows_won(
        [
            run(0, "2024-01-01 00:00:00", "2024-01-03 11:55:00"),
            run(1, "2024-01-02 00:00:00", "2024-01-02 23:55:00"),
            run(2, "2024-01-03 06:00:00", "2024-01-03 07:00:00"),
            run(3, "2024-01-09 00:00:00", "2024-01-09 00:00:00"),
        ]
    )
    assert [(w.run_date.day, w.window_date.day, w.first[11:], w.before) for w in won] == [
        (1, 1, "00:00:00", "2024-01-02 00:00:00"),
        (1, 2, "23:55:01", "2024-01-03 00:00:00"),
        (1, 3, "00:00:00", "2024-01-03 06:00:00"),
        (1, 3, "07:00:01", "2024-01-03 11:55:01"),
        (2, 2, "00:00:00", "2024-01-02 23:55:01"),
        (3, 3, "06:00:00", "2024-01-03 07:00:01"),
        (4, 9, "00:00:00", "2024-01-09 00:00:01"),
    ]
    assert windows_won([]) == []


def test_mart_reads_winning_days_only(spark, made, rows, plan, tmp_path):
    path = str(tmp_path / "m")
    assert read_mart(spark, path).count() == 0
    for k in (3, 0, 1, 2, 1):
        as_of = AS_OF + timedelta(days=k)
        write_mart(window_fill(made, spine_for(as_of)), path, as_of)
        assert rows(read_mart(spark, path)) == rows(mart_scan(spark.read.parquet(path)))
    found = plan(read_mart(spark, path))
    listed = set(re.findall(r"run_date=([-0-9]+)/window_date=([-0-9]+)", found))
    # A run ends at noon of its fourth day, where the next one goes on.
    assert ("2018-06-30", "2018-06-30") not in listed and ("2018-06-30", "2018-06-29") in listed
    expected = rows(read_mart(spark, path))
    assert prune_mart(spark, path) > 0 and prune_mart(spark, path) == 0
    assert rows(read_mart(spark, path)) == expected


def test_a_mart_run_with_fewer_days_leaves_its_own_rows(spark, made, tmp_path):
    path = str(tmp_path / "m")
    filled = window_fill(made, spine_for(AS_OF))
    write_mart(filled, path, AS_OF)
    write_mart(filled.where("datewindows < '2018-06-30'"), path, AS_OF)
    assert read_mart(spark, path).count() == spark.read.parquet(path).count() == 288


def test_a_column_keeps_its_type(spark, made, tmp_path):
    path = str(tmp_path / "b")
    write_batch(made, path, "q-0", "messagedate")
    with pytest.raises(ValueError, match="value is string and not int"):
        write_batch(made.withColumn("value", F.lit(1)), path, "q-1", "messagedate")


def test_position_of_a_message_orders_all_partitions(spark, rows):
    text = '{{"name": "n", "messageid": "{0}", "messagedate": "20180629170000", "metrics": "m", "value": "{0}"}}'
    noon = datetime(2018, 6, 29, 12)
    # Broker's time first, then partition, then offset; the offset alone says nothing.
    records = [(text.format(i), "t", part, offset, noon + timedelta(seconds=s)) for i, part, offset, s in ((1, 0, 900, 0), (2, 1, 5, 0), (3, 2, 1, -1))]
    schema = "value string, topic string, partition int, offset long, timestamp timestamp"
    for order in (records, records[::-1]):
        puts = None
        for k, record in enumerate(order):
            read = placed(decode(message_values(spark.createDataFrame([record], schema))))
            cells = to_cells(read, arrival=F.lit(k))
            puts = cells if puts is None else puts.unionByName(cells)
        assert rows(latest_cells(puts), "value") == [("2",)]


def test_catalog_table_follows_the_log(spark, made, rows, plan, tmp_path):
    path = str(tmp_path / "it's")
    with pytest.raises(ValueError):
        register(spark, "catalogued", path)
    write_batch(made, path, "q-0", "messagedate")
    register(spark, "catalogued", path)
    assert rows(spark.table("catalogued"), *READING_FIELDS) == rows(made)
    write_batch(made.where("messageid = 'b'"), path, "q-0", "messagedate")
    write_batch(made, path, "q-1", "messagedate")
    assert refresh(spark, "catalogued", path) == (4, 3) and refresh(spark, "catalogued", path) == (0, 0)
    assert rows(spark.table("catalogued"), "messageid") == [("a",), ("b",), ("b",), ("c",)]
    day = spark.sql("SELECT * FROM catalogued WHERE event_date = DATE '2018-06-29'")
    assert rows(day, "messageid") == [("b",), ("b",)]
    # The catalog hands out the folders of that day, and knows their size.
    assert "event_date=2018-06-29" in plan(day) and "event_date=2018-06-30" not in plan(day)
    batch = spark.table("catalogued").where("messageid = 'a'").first()["batch"]
    told = spark.sql(f"DESCRIBE EXTENDED catalogued PARTITION (batch = '{batch}', event_date = DATE '2018-06-28')")
    assert "bytes" in told.where("col_name = 'Partition Statistics'").first()["data_type"]
    drop_table(spark, "catalogued")
    assert history(spark, path).count() == 4
