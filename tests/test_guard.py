import pytest

from telltale.operators.alerts import run_rule_text
from telltale.operators.guard import RefusedRule
from telltale.plans.queries import RULE_TEXT

VIEWS = ("inbox", "rules")


@pytest.fixture
def views(spark, readings):
    readings(("1", "2018-06-29 00:00:00", "car", "speed", "150.5"), ("2", "2018-06-29 00:00:00", "car", "speed", "140")).createOrReplaceTempView("inbox")
    spark.createDataFrame([("speed", "130")], "metrics string, value string").createOrReplaceTempView("rules")
    spark.createDataFrame([("x",)], "secret string").createOrReplaceTempView("other")
    yield
    for name in ("inbox", "rules", "other"):
        spark.catalog.dropTempView(name)


ACCEPTED = [
    (RULE_TEXT.format(inbox="inbox", rules="rules"), [("car", 2, 150)]),
    ("SELECT name FROM Inbox WHERE value > (SELECT max(int(value)) FROM rules) AND messageid IN (SELECT min(messageid) FROM inbox)", [("car",)]),
    ("WITH high AS (SELECT * FROM inbox WHERE int(value) > 145) SELECT h.messageid FROM high h JOIN rules USING (metrics)", [("1",)]),
    ("SELECT name, row_number() OVER (PARTITION BY name ORDER BY messageid DESC) AS n FROM inbox ORDER BY n LIMIT 1", [("car", 1)]),
    ("SELECT messageid FROM inbox UNION ALL SELECT metrics FROM rules", [("1",), ("2",), ("speed",)]),
    ("SELECT part FROM inbox LATERAL VIEW explode(split(name, 'a')) t AS part WHERE messageid = '1'", [("c",), ("r",)]),
    ("VALUES ('a')", [("a",)]),
]
REFUSED = [
    ("DROP VIEW other", "not allowed"),
    ("INSERT INTO kept SELECT * FROM inbox", "not allowed"),
    ("CREATE TABLE kept AS SELECT * FROM inbox", "not allowed"),
    ("SET spark.sql.ansi.enabled = false", "not allowed"),
    ("SELECT TRANSFORM (name) USING 'cat' FROM inbox", "not allowed"),
    ("SELECT * FROM range(1000000000000)", "not allowed"),
    ("SELECT * FROM other", "reads inbox and rules only"),
    ("SELECT * FROM inbox WHERE name IN (SELECT secret FROM other)", "reads inbox and rules only"),
    ("SELECT (SELECT max(secret) FROM other) FROM inbox", "reads inbox and rules only"),
    ("SELECT * FROM parquet.`/etc`", "reads inbox and rules only"),
    ("SELECT * FROM (WITH other AS (SELECT 1 AS a) SELECT * FROM other) x JOIN other ON true", "reads inbox and rules only"),
    ("SELECT java_method('java.lang.System', 'exit', 1) FROM inbox", "functions of SQL"),
    ("SELECT reflect('java.lang.System', 'exit', 1) FROM inbox", "functions of SQL"),
    ("SELECT a.name FROM inbox a, inbox b", "equal columns"),
    ("SELECT a.name FROM inbox a JOIN inbox b ON a.value < b.value", "equal columns"),
    ("SELECT 1; DROP VIEW other", "not one SQL query"),
    ("SELEC name FROM inbox", "not one SQL query"),
    ("", "not one SQL query"),
]


@pytest.mark.parametrize("text, expected", ACCEPTED)
def test_accepted(spark, views, rows, text, expected):
    assert rows(run_rule_text(spark, text, VIEWS)) == sorted(expected)


@pytest.mark.parametrize("text, why", REFUSED)
def test_refused_before_anything_runs(spark, views, text, why):
    with pytest.raises(RefusedRule, match=why):
        run_rule_text(spark, text, VIEWS)
    assert spark.table("other").count() == 1 and not spark.catalog.tableExists("kept")
