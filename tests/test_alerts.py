import random

import pytest

from telltale.operators.alerts import alert_details, alerts, hot_metrics, run_rule_text
from telltale.plans.queries import RULE_TEXT, registered
from telltale.sources.rules import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    RuleSet,
    check_rules,
    csv_rules,
    delimited_rules,
    literal_rules,
    reloaded,
)

TIME = "2018-06-29 17:00:00"


def _rules(spark, *rows):
    return check_rules(literal_rules(spark, rows))


@pytest.mark.parametrize(
    ("mod", "value", "raised"),
    [
        ("ltgt", "130.4", False),
        ("ltgt", "131.0", True),
        ("ltgt", "129.9", True),
        ("gt", "131", True),
        ("gt", "129", False),
        ("lt", "129", True),
        ("lt", "131", False),
        ("eq", "130.9", True),
        ("eq", "131", False),
        ("gteq", "130", False),
        ("gteq", "131", True),
        ("ne", "131", False),
        ("ltgt", "abc", False),
        ("ltgt", None, False),
        ("ltgt", "9999999999.5", False),
    ],
)
def test_modes(spark, readings, rows, mod, value, raised):
    made = readings(("m", TIME, "car", "speed", value))
    rules = _rules(spark, ("speed", "130", "50", mod))
    assert rows(alerts(made, rules)) == ([("car", "speed", "130")] if raised else [])
    spread = alert_details(made, RuleSet(rules.frame, small=False), salts=3)
    assert spread.count() == int(raised)


def test_reading_without_rule_and_rule_without_reading(spark, readings):
    made = readings(("m", TIME, "car", "unknown", "1"), ("n", TIME, "car", None, "1"))
    assert alerts(made, _rules(spark, ("speed", "130", "50", "ltgt"))).isEmpty()


def test_alert_shows_the_threshold_and_the_detail_both(spark, readings, rows):
    made = readings(("m", TIME, "car", "speed", "150.2"))
    rules = _rules(spark, ("speed", "130", "50", "ltgt"))
    assert rows(alerts(made, rules)) == [("car", "speed", "130")]
    assert rows(alert_details(made, rules), "value", "threshold", "mod") == [
        ("150.2", "130", "ltgt")
    ]


def test_several_rules_for_one_metric(spark, readings, rows):
    made = readings(("m", TIME, "car", "speed", "150"))
    rules = _rules(
        spark, ("speed", "130", "1", "gt"), ("speed", "200", "1", "lt"), ("speed", "150", "1", "eq")
    )
    assert rows(alerts(made, rules), "value") == [("130",), ("150",), ("200",)]


def test_rule_given_twice_is_refused(spark):
    once = ("speed", "130", "50", "ltgt")
    with pytest.raises(ValueError, match="more than once"):
        _rules(spark, once, once)
    other = literal_rules(spark, [once, ("speed", "140", "50", "ltgt")])
    with pytest.raises(ValueError, match="more than once"):
        check_rules(other)
    assert check_rules(other, unique=("metrics", "value", "mod")).small


def test_size_of_rules_decides_about_the_broadcast(spark):
    many = spark.range(BROADCAST_ROWS + 1).selectExpr(
        "CAST(id AS string) metrics", "'1' value", "'1' ent", "'gt' mod"
    )
    assert not check_rules(many).small
    wide = spark.range(2).selectExpr(
        f"repeat('x', {BROADCAST_BYTES}) || id AS metrics", "'1' value", "'1' ent", "'gt' mod"
    )
    assert not check_rules(wide).small
    assert check_rules(many.limit(10)).small
    assert not check_rules(many.limit(10), broadcast_rows=9).small


def test_large_rules_agree_with_brute_force_on_a_hot_metric(spark, readings, rows):
    draw = random.Random(7)
    names = ["hot"] * 6 + [f"m{i}" for i in range(8)]
    made = [
        (str(i), TIME, "car", draw.choice(names), str(draw.randrange(0, 40) / 4))
        for i in range(900)
    ]
    rule_list = [
        (m, str(draw.randrange(0, 10)), "1", mod)
        for m in {*names}
        for mod in ("gt", "lt", "eq", "ltgt")
        if draw.random() < 0.7
    ]
    expected = []
    for mid, _, _, metric, value in made:
        for rule_metric, limit, _, mod in rule_list:
            a, b = int(float(value)), int(limit)
            if metric == rule_metric and (
                ("gt" in mod and a > b) or ("lt" in mod and a < b) or (mod == "eq" and a == b)
            ):
                expected.append((mid, limit, mod))
    rules = literal_rules(spark, rule_list)
    for small in (True, False):
        found = alert_details(readings(*made), RuleSet(rules, small), salts=5)
        assert rows(found, "messageid", "threshold", "mod") == sorted(expected)


def test_plans(spark, readings, plan):
    made = readings(("m", TIME, "car", "speed", "150"))
    rules = _rules(spark, ("speed", "130", "50", "ltgt"))
    small = plan(alerts(made, rules))
    assert "BroadcastHashJoin" in small and "LeftOuter" not in small
    assert "Exchange" not in small.replace("BroadcastExchange", "")
    assert "PythonUDF" not in small and "BatchEvalPython" not in small


def test_large_rules_shuffle_by_metric_and_salt(spark, readings, plan, rows):
    """No broadcast whatever the optimizer thinks of the size; copies for the hot metric only."""
    made = [(str(i), TIME, "car", "hot" if i % 3 else str(i), "150") for i in range(300)]
    rules = spark.range(300).selectExpr(
        "IF(id = 0, 'hot', CAST(id AS string)) metrics", "'1' value", "'1' ent", "'gt' mod"
    )
    assert hot_metrics(readings(*made), 8) == ["hot"]
    found = alert_details(readings(*made), RuleSet(rules, small=False), salts=8)
    shown = plan(found)
    assert "SortMergeJoin" in shown and "Broadcast" not in shown
    assert "hashpartitioning(metrics" in shown and "salt" in shown
    assert rows(found) == rows(alert_details(readings(*made), check_rules(rules)))
    assert found.count() == 299  # reading 0 has a metric without a rule


def test_registered_large_rules_are_shuffled(spark, plan):
    query = registered()["alerts_large_rules"]
    shown = plan(query(spark, "/root/testdata/sf0.01"))
    assert "SortMergeJoin" in shown and "BroadcastHashJoin" not in shown


def test_rules_are_loaded_now_and_then():
    loads = []
    current = reloaded(lambda: loads.append(1) or len(loads), seconds=3600)
    assert [current() for _ in range(5)] == [1] * 5
    always = reloaded(lambda: loads.append(1) or len(loads), seconds=0)
    assert [always() for _ in range(2)] == [2, 3]


def test_rule_text_with_old_casts(spark, readings, rows):
    made = readings(
        ("a", TIME, "car", "speed", "190.857"),
        ("b", TIME, "car", "speed", "abc"),
        ("c", TIME, "car", "speed", "131.9"),
        ("d", TIME, "bus", "speed", "150"),
    )
    made.createOrReplaceTempView("inbox")
    literal_rules(spark, [("speed", "130", "50", "ltgt")]).createOrReplaceTempView("rules")
    before = spark.conf.get("spark.sql.ansi.enabled")
    found = run_rule_text(spark, RULE_TEXT.format(inbox="inbox", rules="rules"))
    assert spark.conf.get("spark.sql.ansi.enabled") == before
    assert rows(found) == [("car", 2, 190)]


def test_queries_leave_no_views(spark):
    before = {t.name for t in spark.catalog.listTables()}
    for name in ("alerts_sql_rule", "inbox_view"):
        assert registered()[name](spark, "/root/testdata/sf0.001").count() >= 0
    assert {t.name for t in spark.catalog.listTables()} == before


def test_rules_from_quoted_csv(spark, rows, tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text(
        '"metrics","value","ent","mod"\n"tire-pressure","3"," 0.5","ltgt"\n"a,b","1","2","gt"\n'
    )
    assert rows(csv_rules(spark, str(path))) == [
        ("a,b", "1", "2", "gt"),
        ("tire-pressure", "3", " 0.5", "ltgt"),
    ]


def test_rules_from_delimited_text(spark, rows, tmp_path):
    path = tmp_path / "rules.txt"
    path.write_text("tire-pressure,3,0.5,ltgt\na\\,b,1,\\N,gt\nx\\\\,2,,lt\n")
    assert rows(delimited_rules(spark, str(path))) == [
        ("a,b", "1", None, "gt"),
        ("tire-pressure", "3", "0.5", "ltgt"),
        ("x\\", "2", "", "lt"),
    ]


def test_literal_rules_keep_their_order_of_fields(spark, rows):
    given = [(f"m{i}", str(i), f"e{i}", "gt") for i in range(30)]
    assert rows(literal_rules(spark, given)) == sorted(given)
