import json
import random
from datetime import date, datetime, timedelta

import pytest

from telltale.__main__ import archive, batch, main, once, parser, speed
from telltale.operators.serving import mart_scan
from telltale.sinks.tables import packed_batches, read_packed
from telltale.sources.readings import history
from telltale.streaming.speed import read_output

RULES = (("speed", "130", "50", "ltgt"), ("driver-pulse", "90", "9", "gt"), ("heat", "5", "1", "lt"))


@pytest.fixture
def rules_file(tmp_path):
    lines = ['"metrics","value","ent","mod"']
    lines += [",".join(f'"{field}"' for field in rule) for rule in RULES]
    path = tmp_path / "rules.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def text(tmp_path):
    """300 messages of five minutes in three files."""
    draw = random.Random(4)
    folder = tmp_path / "text"
    folder.mkdir()
    for part in range(3):
        with (folder / f"{part}.txt").open("w") as file:
            for k in range(100):
                time = datetime(2018, 6, 29, 12) + timedelta(seconds=2 * k)
                metric, value, _, _ = draw.choice(RULES)
                member = {
                    "name": f"car {k % 7}",
                    "messageid": f"{part}-{k}",
                    "messagedate": time.strftime("%Y%m%d%H%M%S"),
                    "metrics": metric,
                    "value": str(float(value) + draw.uniform(-3, 3)),
                }
                file.write(json.dumps(member) + "\n")
    return str(folder)


def test_from_messages_to_the_mart(spark, rules_file, text, tmp_path, rows):
    out, mart, packs = (str(tmp_path / n) for n in ("out", "mart", "packs"))
    layer = ["--rules", rules_file, "--text", text]
    options = ["speed", *layer, "--out", out, "--checkpoint", str(tmp_path / "s"), "--drain"]
    speed(spark, parser().parse_args([*options, "--max-per-batch", "1"]))
    assert history(spark, f"{out}/history").count() == 300
    days = tmp_path / "out" / "history"
    assert len(list(days.glob("batch=*/event_date=2018-06-29"))) == 3  # one file a batch, as was asked
    alerts = read_output(spark, f"{out}/alerts").count()
    assert 100 < alerts < 300

    single = str(tmp_path / "single")
    once(spark, parser().parse_args(["once", *layer, "--out", single, "--run", "r"]))
    assert read_output(spark, f"{single}/alerts").count() == alerts

    archive(spark, parser().parse_args(["archive", "--out", out, "--archive", packs]))
    for table in ("history", "alerts", "cells"):
        live, packed = f"{out}/{table}", f"{packs}/{table}"
        assert packed_batches(spark, packed).count() == 3
        columns = [c for c in read_output(spark, live).columns]
        assert rows(read_packed(spark, live, packed), *columns) == rows(
            read_output(spark, live), *columns
        )

    options = ["batch", "--history", f"{out}/history", "--mart", mart, "--as-of", "2018-06-30"]
    batch(spark, parser().parse_args([*options, "--archive", f"{packs}/history"]))
    stored = mart_scan(spark.read.parquet(mart))
    assert stored.count() == 1000 - 1 + 300  # all readings lie in one window
    assert stored.where("value IS NOT NULL").count() == 300


def test_a_job_has_to_be_named():
    with pytest.raises(SystemExit):
        main([])


def test_day_of_a_batch_run():
    job = ["batch", "--history", "h", "--mart", "m"]
    assert parser().parse_args(job).as_of is None
    dated = parser().parse_args([*job, "--as-of", "2018-06-30"])
    assert dated.as_of == date(2018, 6, 30)
