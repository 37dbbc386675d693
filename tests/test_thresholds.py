import random

import pytest
from pyspark.sql import functions as F

from telltale.operators import alerts as operator
from telltale.operators.alerts import alert_details, fires
from telltale.operators.thresholds import threshold_blocks
from telltale.sources.rules import check_rules

UNIQUE = ("metrics", "mod", "value")


@pytest.fixture
def many(spark):
    """Rules of one crowded metric and a few others, with odd values and modes."""
    draw = random.Random(3)
    rows = {("speed", str(draw.choice([draw.randint(-40, 300), draw.uniform(0, 99)])), m) for m in ("gt", "lt", "ltgt", "eq") for _ in range(90)}
    rows |= {("speed", "no number", "gt"), ("speed", "7", "unknown"), ("heat", "3", "lt"), ("heat", "3.9", "eq")}
    return spark.createDataFrame([(m, v, "1", k) for m, v, k in sorted(rows)], "metrics string, value string, ent string, mod string")


@pytest.fixture
def seen(readings):
    values = ["-41", "-40", "0", "3", "3.99", "7", "55.5", "299", "300", "301", "2147483648", "abc", None]
    rows = [(f"{m}{i}", "2018-06-29 00:00:00", "car", m, v) for m in ("speed", "heat", "none") for i, v in enumerate(values)]
    return readings(*rows, (None, "2018-06-29 00:00:00", None, None, "5"))


def by_pairs(seen, rules):
    """Each reading with each rule of its metric."""
    from telltale.functions.numbers import truncated_int

    limits = rules.select("metrics", F.col("value").alias("threshold"), "mod", truncated_int(F.col("value")).alias("limit"))
    met = seen.withColumn("seen", truncated_int(F.col("value"))).join(limits, "metrics")
    return met.where(fires(F.col("seen"), F.col("limit"), F.col("mod"))).select(
        "messageid", "messagedate", "name", "metrics", "value", "threshold", "mod"
    )


@pytest.mark.parametrize("block", [1024, 16, 1])
@pytest.mark.parametrize("bound", [100_000, 5])
def test_against_all_pairs(spark, many, seen, rows, monkeypatch, block, bound):
    monkeypatch.setattr("telltale.operators.thresholds.BLOCK", block)
    monkeypatch.setattr(threshold_blocks, "__defaults__", (block,))
    rules = check_rules(many, unique=UNIQUE, broadcast_rows=bound)
    assert rules.most > 300 and rules.small == (bound > 5)
    found = rows(alert_details(seen, rules, salts=4))
    assert found == rows(by_pairs(seen, many)) and len(found) > 1000


def test_few_rules_are_joined(many, seen, rows, plan, monkeypatch):
    rules = check_rules(many, unique=UNIQUE)
    assert "Generate" in plan(alert_details(seen, rules))
    monkeypatch.setattr(operator, "CROWDED", 10_000)
    joined = alert_details(seen, rules)
    assert "Generate" not in plan(joined)
    assert rows(joined) == rows(by_pairs(seen, many))


def test_readings_meet_arrays_and_not_rules(many, seen):
    blocks = threshold_blocks(many, 400)
    assert blocks.count() == 2
    sizes = blocks.select(F.size("above"), F.size("below"), F.size("equal")).where("metrics = 'speed'").first()
    assert all(n > 80 for n in sizes)


def test_no_rules(spark, many, seen):
    assert alert_details(seen, check_rules(many.limit(0), unique=UNIQUE)).count() == 0
