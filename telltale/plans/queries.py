"""Every operator as a query over the ``events`` table.

Times leave as text, because engines differ in how they hand out timestamps.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telltale.fixed import MINUTES_FORMAT, SECONDS_FORMAT
from telltale.functions.numbers import number
from telltale.functions.times import bucket_start, label
from telltale.operators import serving
from telltale.operators.alerts import alert_details, alerts, run_rule_text
from telltale.operators.cells import latest_cells, to_cells, wide_cells
from telltale.operators.decode import bad, decode, encode, good, placed
from telltale.operators.windows import (
    spine_for,
    spine_over,
    window_coverage,
    window_fill,
    window_fill_nonempty,
)
from telltale.schema import READING, READING_FIELDS, RULE
from telltale.session import run_dir, use_utc
from telltale.sinks.catalog import refresh, register
from telltale.sinks.cellstore import fold, latest_stored, lookup
from telltale.sinks.exports import read_quoted_csv, write_quoted_csv
from telltale.sinks.tables import (
    append_by_date,
    append_table,
    create_table,
    drop_table,
    insert_rows,
    merge_packs,
    pack_batches,
    prune_mart,
    read_mart,
    read_packed,
    vacuum,
    write_batch,
    write_mart,
)
from telltale.sources.readings import (
    event_measures,
    event_reading_stream,
    event_readings,
    events,
    history,
    message_values,
    text_messages,
)
from telltale.sources.rules import (
    RuleSet,
    check_rules,
    csv_rules,
    delimited_rules,
    literal_rules,
)
from telltale.streaming.dashboard import read_window_max, start_window_max
from telltale.streaming.replay import quarantined, replay
from telltale.streaming.speed import SpeedLayer, read_output, run_once

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 1, 2)

# One rule per mode; `error` events have none.
EVENT_RULES = (
    ("view", "50", "40", "ltgt"),
    ("click", "40", "10", "gt"),
    ("purchase", "12", "5", "lt"),
    ("signup", "51", "20", "eq"),
)

EVENT_WIDE_COLUMNS = (
    ("views", "car", "view"),
    ("clicks", "car", "click"),
    ("purchases", "car", "purchase"),
    ("signups", "car", "signup"),
    ("errors", "car", "error"),
)

# Event types as the metrics of the car example.
CAR_METRICS = (
    ("view", "driver-blood-pressure"),
    ("click", "tire-pressure"),
    ("purchase", "current-speed"),
    ("signup", "current-location-lat"),
    ("error", "engine-heat"),
)

# A rule query as a user of the older casts writes it: names with several
# readings over the limit of their metric.
RULE_TEXT = """
SELECT name, count(1) AS n, bigint(max(int(value))) AS top
FROM (SELECT {inbox}.name, {inbox}.value, int({rules}.value) AS bound
      FROM {inbox}, {rules} WHERE {inbox}.metrics = {rules}.metrics)
WHERE int(value) > bound
GROUP BY name HAVING n > 1;
"""

# The end of a week of events, and names whose rows are looked up.
WEEK_END = "2024-01-08 00:00:00"
LOOKED_UP = "U-1"

# Large rules: one per user and type, more than may be broadcast there.
LARGE_RULES = 200


def _rules(spark: SparkSession, mode: str | None = None) -> RuleSet:
    # Four literal rows: small and unique as they stand.
    rows = [r for r in EVENT_RULES if mode is None or r[3] == mode]
    return RuleSet(literal_rules(spark, rows), small=True)


def _timed(readings: DataFrame) -> DataFrame:
    return readings.withColumn("messagedate", label(F.col("messagedate")))


# Decoding


def decode_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(good(decode(encode(event_readings(spark, sf_dir)))))


def decode_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose time has 12 digits."""
    readings = event_readings(spark, sf_dir)
    members = {f: F.col(f) for f in READING_FIELDS}
    members["messagedate"] = F.date_format("messagedate", MINUTES_FORMAT)
    message = F.to_json(F.struct(*[c.alias(f) for f, c in members.items()]))
    return _timed(good(decode(readings.select(message.alias("value")))))


def _some_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of events, damaged in another way for each of three event types."""
    kind = F.col("metrics")
    time = F.date_format("messagedate", SECONDS_FORMAT)
    message = F.to_json(
        F.struct(
            "name",
            F.when(kind != "signup", F.col("messageid")).alias("messageid"),
            F.when(kind == "click", "2024-01").otherwise(time).alias("messagedate"),
            "metrics",
            "value",
        )
    )
    text = F.when(kind == "error", F.concat(F.lit("{bad "), "value")).otherwise(message)
    return event_readings(spark, sf_dir).select(text.alias("value"))


def decode_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad messages as they came, each with its problem."""
    return bad(decode(_some_broken(spark, sf_dir)))


def decode_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through text files, one per line."""
    path = run_dir(spark, "messages")
    encode(event_readings(spark, sf_dir)).write.text(path)
    return _timed(good(decode(text_messages(spark, path))))


def reading_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wire form, taken back from the binary value of a key-value record."""
    sent = encode(event_readings(spark, sf_dir))
    return message_values(sent.select(F.encode("value", "UTF-8").alias("value")))


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k bigint")
    return events(spark, sf_dir).select("event_id", props["k"].alias("k"))


# Alerts


def alerts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(event_readings(spark, sf_dir), _rules(spark))


def _alerts_of(mode: str) -> Query:
    return lambda spark, sf_dir: alerts(event_readings(spark, sf_dir), _rules(spark, mode))


def alerts_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(alert_details(event_readings(spark, sf_dir), _rules(spark)))


def alerts_large_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules too many to broadcast: one per user and type, with a limit of its own."""
    metric = F.concat_ws("/", F.substring("name", 3, 20), "metrics")
    readings = event_readings(spark, sf_dir).withColumn("metrics", metric)
    user, kind = F.col("user_id"), F.col("event_type")
    rules = (
        events(spark, sf_dir)
        .select("user_id", "event_type")
        .distinct()
        .select(
            F.concat_ws("/", user.cast("string"), kind).alias("metrics"),
            F.pmod(user * 7, F.lit(90)).cast("string").alias("value"),
            F.lit("1").alias("ent"),
            F.when(user % 3 == 0, "lt").when(user % 3 == 1, "gt").otherwise("ltgt").alias("mod"),
        )
    )
    checked = check_rules(rules, broadcast_rows=LARGE_RULES)
    return _timed(alert_details(readings, checked))


def _viewed(
    spark: SparkSession, text: str, guarded: bool = False, **frames: DataFrame
) -> DataFrame:
    """Run SQL over frames under names that nobody else has."""
    names = {place: f"{place}_{uuid.uuid4().hex}" for place in frames}
    for place, frame in frames.items():
        frame.createOrReplaceTempView(names[place])
    try:
        return run_rule_text(spark, text.format(**names), names.values() if guarded else None)
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)


def alerts_sql_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = literal_rules(spark, EVENT_RULES)
    return _viewed(spark, RULE_TEXT, inbox=event_readings(spark, sf_dir), rules=rules)


def inbox_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox = event_readings(spark, sf_dir)
    return _timed(_viewed(spark, "SELECT * FROM {inbox}", inbox=inbox))


def alerts_rules_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "rules-csv")
    write_quoted_csv(literal_rules(spark, EVENT_RULES), path)
    return alerts(event_readings(spark, sf_dir), check_rules(csv_rules(spark, path)))


def alerts_rules_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "rules-text")
    literal_rules(spark, EVENT_RULES).select(F.concat_ws(",", *RULE.names)).write.text(path)
    return alerts(event_readings(spark, sf_dir), check_rules(delimited_rules(spark, path)))


def alerts_rules_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"rules_{uuid.uuid4().hex}"
    create_table(spark, name, RULE, run_dir(spark, "rules-table"))
    insert_rows(spark, name, list(EVENT_RULES))
    found = alerts(event_readings(spark, sf_dir), check_rules(spark.table(name)))
    drop_table(spark, name)
    return found


# Windows


def window_fill_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_fill(event_readings(spark, sf_dir), spine_for(AS_OF))


def window_fill_nonempty_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_fill_nonempty(event_readings(spark, sf_dir), spine_for(AS_OF))


def window_fill_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table on one spine."""
    readings = event_readings(spark, sf_dir)
    return window_fill(readings, spine_over(readings))


def window_coverage_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_coverage(event_readings(spark, sf_dir), spine_for(AS_OF))


def mart_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "mart")
    write_mart(window_fill_run(spark, sf_dir), path, AS_OF)
    return serving.mart_scan(spark.read.parquet(path))


def mart_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of two days that overlap, and the first one repeated."""
    path = run_dir(spark, "mart")
    for as_of in (AS_OF, AS_OF + timedelta(days=1), AS_OF):
        readings = event_readings(spark, sf_dir)
        write_mart(window_fill(readings, spine_for(as_of)), path, as_of)
    return serving.mart_scan(spark.read.parquet(path))


# Cells


def _bucket_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_readings(spark, sf_dir)
    return to_cells(readings, stamp=bucket_start(F.col("messagedate"), 300))


def cells_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of puts of equal versions; the later one's ids come first as text."""
    path = run_dir(spark, "cells")
    bucket = bucket_start(F.col("messagedate"), 300)
    readings = event_readings(spark, sf_dir)
    number = F.col("messageid").cast("long")
    batches = (
        readings.withColumn("messageid", F.concat(F.lit("z"), "messageid")),
        readings.where(number % 2 == 0).withColumn("messageid", F.concat(F.lit("a"), "messageid")),
    )
    for k, batch in enumerate(batches):
        puts = to_cells(batch, stamp=bucket, version=bucket, arrival=F.lit(k))
        write_batch(puts, path, f"put-{k}", "version")
    return latest_cells(read_output(spark, path))


def cells_wide_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide car view, with event types as metrics of cars."""
    names = F.create_map(*[F.lit(x) for pair in CAR_METRICS for x in pair])
    readings = event_readings(spark, sf_dir).withColumn("metrics", names[F.col("metrics")])
    return wide_cells(to_cells(readings, stamp=bucket_start(F.col("messagedate"), 300)))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_cells(event_readings(spark, sf_dir)).select(
        "row_key", "family", "qualifier", "value"
    )


def cells_one_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_cells(event_readings(spark, sf_dir), metric="view").select(
        "row_key", "family", "qualifier", "value"
    )


def cells_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_cells(_bucket_cells(spark, sf_dir))


def cells_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_cells(_bucket_cells(spark, sf_dir), EVENT_WIDE_COLUMNS)


# Serving


def dashboard_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.dashboard_strict(event_measures(spark, sf_dir))


def dashboard_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.dashboard_max(event_measures(spark, sf_dir))


def dashboard_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up over the latest cells of one metric."""
    latest = latest_cells(to_cells(event_readings(spark, sf_dir)))
    return serving.dashboard_max(serving.keyed_measures(latest, "purchase"))


def dashboard_max_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maxima of a stream whose batches come with the latest readings first."""
    out = run_dir(spark, "dashboard")
    measures = event_readings(spark, sf_dir).select(
        "name",
        F.col("messagedate").cast("timestamp").alias("messagedate"),
        number(F.col("value")).alias("sugar"),
    )
    files = max(4, spark.sparkContext.defaultParallelism)
    measures.repartitionByRange(files, F.col("messagedate").desc()).write.parquet(f"{out}/in")
    reader = spark.readStream.schema(measures.schema).option("maxFilesPerTrigger", files // 4)
    stream = reader.parquet(f"{out}/in")
    start_window_max(stream, f"{out}/maxima", f"{out}/state", interval=None).awaitTermination()
    return read_window_max(spark, f"{out}/maxima")


def reading_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.reading_count(event_readings(spark, sf_dir))


def peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(serving.peek(event_readings(spark, sf_dir)))


# Stored tables


def csv_quoted_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "csv")
    table = events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "props")
    write_quoted_csv(table, path)
    return read_quoted_csv(spark, path, table.schema)


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "history")
    append_by_date(event_readings(spark, sf_dir), path)
    return _timed(history(spark, path)).withColumn(
        "event_date", F.col("event_date").cast("string")
    )


def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a catalog table, the second with its columns in another order."""
    name = f"history_{uuid.uuid4().hex}"
    path = run_dir(spark, "appended")
    readings = event_readings(spark, sf_dir)
    readings = readings.withColumn("messagedate", F.col("messagedate").cast("timestamp"))
    create_table(spark, name, READING, path)
    append_table(readings, name, path)
    append_table(readings.select(*reversed(READING_FIELDS)), name, path)
    stored = _timed(spark.table(name))
    drop_table(spark, name)
    return stored


def history_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days up to the cutoff from packs, the others from the live files."""
    live, archive = run_dir(spark, "live"), run_dir(spark, "archive")
    append_by_date(event_readings(spark, sf_dir), live)
    pack_batches(spark, live, archive, date(2024, 1, 15))
    return _timed(read_packed(spark, live, archive).select(*READING_FIELDS))


def history_archive_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the readings are packed; the other half of the same days comes after."""
    live, archive = run_dir(spark, "live"), run_dir(spark, "archive")
    readings = event_readings(spark, sf_dir)
    half = F.col("messageid").cast("long") % 2 == 0
    append_by_date(readings.where(half), live)
    pack_batches(spark, live, archive)
    append_by_date(readings.where(~half), live)
    pack_batches(spark, live, archive, date(2024, 1, 10))
    return _timed(read_packed(spark, live, archive).select(*READING_FIELDS))


# The speed layer


def _layer(spark: SparkSession, out: str, **outputs: str) -> SpeedLayer:
    paths = {name: f"{out}/{folder}" for name, folder in outputs.items()}
    return SpeedLayer(rules=_rules(spark), **paths)


def _run_stream(spark: SparkSession, sf_dir: str, **outputs: str) -> str:
    out = run_dir(spark, "speed")
    messages = encode(event_reading_stream(spark, sf_dir))
    layer = _layer(spark, out, **outputs)
    layer.start(messages, f"{out}/state", interval=None).awaitTermination()
    return out


def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _run_stream(spark, sf_dir, alerts_path="alerts")
    return _timed(read_output(spark, f"{out}/alerts"))


def history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _run_stream(spark, sf_dir, history_path="history")
    return _timed(read_output(spark, f"{out}/history"))


def cells_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _run_stream(spark, sf_dir, cells_path="cells")
    return latest_cells(read_output(spark, f"{out}/cells"))


def _once(spark: SparkSession, sf_dir: str) -> str:
    """The one-shot form, with bad messages in quarantine and a user's rule query."""
    out = run_dir(spark, "once")
    layer = SpeedLayer(
        rules=_rules(spark),
        quarantine_path=f"{out}/quarantine",
        on_bad="quarantine",
        rule_text=RULE_TEXT.format(inbox="inbox", rules="rules"),
        rule_text_path=f"{out}/found",
    )
    run_once(layer, _some_broken(spark, sf_dir))
    return out


def alerts_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_output(spark, f"{_once(spark, sf_dir)}/found")


def once_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_output(spark, f"{_once(spark, sf_dir)}/quarantine").select("raw", "problem")


# Batches that are repeated, replayed and moved


def _rerun(spark: SparkSession, sf_dir: str) -> str:
    """A named run over all events, then again over those of a week, with the rules of one mode."""
    out = run_dir(spark, "rerun")
    readings = event_readings(spark, sf_dir)
    week = readings.where(F.col("messagedate") < F.lit(WEEK_END).cast("timestamp_ntz"))
    paths = {"history_path": f"{out}/history", "alerts_path": f"{out}/alerts"}
    run_once(SpeedLayer(rules=_rules(spark), **paths), encode(readings), run="monday")
    run_once(SpeedLayer(rules=_rules(spark, "gt"), **paths), encode(week), run="monday")
    return out


def history_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(read_output(spark, f"{_rerun(spark, sf_dir)}/history"))


def alerts_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(read_output(spark, f"{_rerun(spark, sf_dir)}/alerts"))


def history_vacuumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches, each packed, the packs merged, what nothing reads removed, then one more."""
    live, archive = run_dir(spark, "live"), run_dir(spark, "archive")
    readings = event_readings(spark, sf_dir)
    part = F.col("messageid").cast("long") % 5
    for k in range(4):
        append_by_date(readings.where(part == k), live)
        pack_batches(spark, live, archive)
    merge_packs(spark, archive, fan=2)
    vacuum(spark, live, archive, grace=0)
    append_by_date(readings.where(part == 4), live)
    return _timed(read_packed(spark, live, archive).select(*READING_FIELDS))


def history_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL by date over a catalog table, whose batches are added and one repeated meanwhile."""
    name, path = f"history_{uuid.uuid4().hex}", run_dir(spark, "catalogued")
    readings = event_readings(spark, sf_dir)
    is_even = F.col("messageid").cast("long") % 2 == 0
    write_batch(readings, path, "first", "messagedate")
    register(spark, name, path)
    write_batch(readings.where(is_even), path, "first", "messagedate")
    write_batch(readings.where(~is_even), path, "second", "messagedate")
    refresh(spark, name, path)
    found = spark.sql(
        f"SELECT * FROM {name} WHERE event_date >= DATE '2024-01-05' AND event_date < DATE '2024-01-12'"
    )
    # The name stays: folders are asked of the catalog when the query runs.
    return _timed(found.select(*READING_FIELDS))


def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in quarantine are mended, all but those without an id, and replayed twice."""
    out = run_dir(spark, "replay")
    layer = SpeedLayer(
        rules=_rules(spark),
        history_path=f"{out}/history",
        quarantine_path=f"{out}/quarantine",
        on_bad="quarantine",
    )

    def mended(messages: DataFrame) -> DataFrame:
        value = F.regexp_replace("value", r'"2024-01"', '"20240101000000"')
        return messages.withColumn("value", value)

    run_once(layer, _some_broken(spark, sf_dir))
    for _ in range(2):
        replay(spark, layer, mended)
    found = _timed(read_output(spark, f"{out}/history"))
    left = quarantined(spark, f"{out}/quarantine").select("raw", "problem")
    return found.unionByName(left, allowMissingColumns=True)


def cells_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five batches of puts, the runs of a store folded and merged after some of them."""
    log, store = run_dir(spark, "cells"), run_dir(spark, "store")
    puts = _bucket_cells(spark, sf_dir)
    part = F.col("messageid").cast("long") % 5
    for k in range(5):
        write_batch(puts.where(part == k), log, f"put-{k}", "version")
        if k < 4:
            fold(spark, log, store, fan=3, buckets=8)
    return latest_stored(spark, log, store)


def cells_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the names that begin alike, from the runs of a store and what came after."""
    log, store = run_dir(spark, "cells"), run_dir(spark, "store")
    puts = _bucket_cells(spark, sf_dir)
    is_old = F.col("messageid").cast("long") % 3 < 2
    write_batch(puts.where(is_old), log, "old", "version")
    fold(spark, log, store, buckets=8)
    write_batch(puts.where(~is_old), log, "new", "version")
    return lookup(spark, log, store, prefix=LOOKED_UP)


def cells_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Puts of equal versions from three topic partitions; the later half comes first."""
    path = run_dir(spark, "cells")
    readings = event_readings(spark, sf_dir)
    number = F.col("messageid").cast("long")
    members = {f: F.col(f) for f in READING_FIELDS}
    members["messagedate"] = F.date_format("messagedate", SECONDS_FORMAT)
    records = readings.select(
        F.to_json(F.struct(*[c.alias(f) for f, c in members.items()])).alias("value"),
        F.date_trunc("minute", F.col("messagedate").cast("timestamp")).alias("timestamp"),
        F.lit("readings").alias("topic"),
        (number % 3).cast("int").alias("partition"),
        number.alias("offset"),
        (number % 2 == 0).alias("early"),
    )
    bucket = bucket_start(F.col("messagedate"), 300)
    for k, early in enumerate((False, True)):
        messages = message_values(records.where(F.col("early") == early))
        read = placed(decode(messages))
        puts = to_cells(read, stamp=bucket, version=bucket, arrival=F.lit(k))
        write_batch(puts, path, f"put-{k}", "version")
    return latest_cells(read_output(spark, path))


def alerts_many_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four hundred thresholds for each event type, which are searched and not joined."""
    step = F.explode(F.sequence(F.lit(0), F.lit(399))).alias("i")
    kinds = events(spark, sf_dir).select("event_type").distinct().select("event_type", step)
    i = F.col("i")
    rules = kinds.select(
        F.col("event_type").alias("metrics"),
        F.when(i % 4 == 0, -i).when(i % 4 == 1, 150 + i).when(i % 4 == 2, 5 * i).otherwise(5 * i)
        .cast("string").alias("value"),
        F.lit("1").alias("ent"),
        F.when(i % 4 == 0, "lt").when(i % 4 == 1, "gt").otherwise("eq").alias("mod"),
    )
    checked = check_rules(rules, unique=("metrics", "mod", "value"))
    return _timed(alert_details(event_readings(spark, sf_dir), checked))


def alerts_rule_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's rule query, looked at before it runs."""
    rules = literal_rules(spark, EVENT_RULES)
    inbox = event_readings(spark, sf_dir)
    return _viewed(spark, RULE_TEXT, guarded=True, inbox=inbox, rules=rules)


def mart_many_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of five days that overlap, in another order, and what they no longer give removed."""
    path = run_dir(spark, "mart")
    for k in (2, 0, 4, 1, 3):
        as_of = AS_OF + timedelta(days=k)
        readings = event_readings(spark, sf_dir)
        write_mart(window_fill(readings, spine_for(as_of)), path, as_of)
    prune_mart(spark, path)
    return read_mart(spark, path)


_QUERIES: dict[str, Query] = {
    "alerts": alerts_all,
    "alerts_detail": alerts_detail,
    "alerts_gt": _alerts_of("gt"),
    "alerts_lt": _alerts_of("lt"),
    "alerts_eq": _alerts_of("eq"),
    "alerts_large_rules": alerts_large_rules,
    "alerts_sql_rule": alerts_sql_rule,
    "alerts_rules_csv": alerts_rules_csv,
    "alerts_rules_delimited": alerts_rules_delimited,
    "alerts_rules_table": alerts_rules_table,
    "alerts_stream": alerts_stream,
    "alerts_once": alerts_once,
    "once_quarantine": once_quarantine,
    "alerts_many_thresholds": alerts_many_thresholds,
    "alerts_rule_guarded": alerts_rule_guarded,
    "alerts_rerun": alerts_rerun,
    "quarantine_replay": quarantine_replay,
    "inbox_view": inbox_view,
    "decode_readings": decode_readings,
    "decode_minutes": decode_minutes,
    "decode_quarantine": decode_quarantine,
    "decode_text_files": decode_text_files,
    "reading_messages": reading_messages,
    "event_props": event_props,
    "window_fill": window_fill_run,
    "window_fill_nonempty": window_fill_nonempty_run,
    "window_fill_history": window_fill_history,
    "window_coverage": window_coverage_run,
    "mart_scan": mart_scan,
    "mart_two_runs": mart_two_runs,
    "mart_many_runs": mart_many_runs,
    "cells": cells,
    "cells_one_metric": cells_one_metric,
    "cells_latest": cells_latest,
    "cells_arrival": cells_arrival,
    "cells_wide_cars": cells_wide_cars,
    "cells_wide": cells_wide,
    "cells_stream": cells_stream,
    "cells_snapshot": cells_snapshot,
    "cells_lookup": cells_lookup,
    "cells_positions": cells_positions,
    "dashboard_strict": dashboard_strict,
    "dashboard_max": dashboard_max,
    "dashboard_cells": dashboard_cells,
    "dashboard_max_stream": dashboard_max_stream,
    "reading_count": reading_count,
    "peek": peek,
    "csv_quoted_roundtrip": csv_quoted_roundtrip,
    "partitioned_roundtrip": partitioned_roundtrip,
    "history_append": history_append,
    "history_archive": history_archive,
    "history_archive_late": history_archive_late,
    "history_catalog": history_catalog,
    "history_rerun": history_rerun,
    "history_vacuumed": history_vacuumed,
    "history_stream": history_stream,
}


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return query(spark, sf_dir)

    return run


def registered() -> dict[str, Query]:
    return {name: _in_utc(query) for name, query in _QUERIES.items()}
