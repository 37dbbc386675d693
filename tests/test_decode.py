from datetime import datetime

from telltale.operators.decode import bad, decode, encode, good
from telltale.sources.readings import message_values, text_messages

# Its time has no seconds.
ONE = (
    '{"value": "41.25", "metrics": "driver-pulse", "messagedate": "202402030915", '
    '"messageid": "id-77", "name": "HH-X 12"}'
)


def _messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def _json(**members):
    import json

    whole = {
        "name": "n",
        "messageid": "m",
        "messagedate": "20180629170000",
        "metrics": "speed",
        "value": "1",
    }
    whole.update(members)
    return json.dumps({k: v for k, v in whole.items() if v is not ...})


def test_one_message(spark, rows):
    assert rows(good(decode(_messages(spark, ONE)))) == [
        ("id-77", datetime(2024, 2, 3, 9, 15), "HH-X 12", "driver-pulse", "41.25")
    ]


def test_bad_messages_are_told_apart_and_kept(spark, rows):
    broken = {
        "{bad": "not a JSON object",
        "[1]": "not a JSON object",
        "null": "not a JSON object",
        "": "not a JSON object",
        None: "not a JSON object",
        "{'name': 'n'}": "not a JSON object",
        _json(name=...): "member missing",
        _json(messageid=...): "member missing",
        _json(metrics=None): "member missing",
        _json(messagedate=...): "member missing",
        _json(messagedate="2018-06"): "time unreadable",
    }
    decoded = decode(_messages(spark, *broken, ONE, _json()))
    assert dict(rows(bad(decoded))) == broken
    assert good(decoded).count() == 2
    assert decoded.count() == len(broken) + 2


def test_value_may_be_null_or_a_bare_number(spark, rows):
    found = good(decode(_messages(spark, _json(value=None), _json(value=12.5))))
    assert rows(found, "value") == [(None,), ("12.5",)]


def test_text_is_parsed_once(spark, plan):
    shown = plan(good(decode(_messages(spark, ONE))))
    assert shown.count("from_json(") <= 2  # one line for the operator, one for its arguments
    filters = [line for line in shown.splitlines() if line.startswith("Condition")]
    assert not any("from_json" in line for line in filters)


def test_quotes_survive_the_wire_form(spark, readings, rows):
    made = readings(
        ("m", "2018-06-29 17:00:00", 'O\'Brien "X"', "a\\b", "1"),
        ("n", "2018-06-29 17:00:01", "ünï-ç", "line\nbreak", "2"),
    )
    assert rows(good(decode(encode(made)))) == rows(made)


def test_text_files_and_binary_values(spark, readings, rows, tmp_path):
    made = readings(("m", "2018-06-29 17:00:00", "car", "speed", "1"))
    sent = encode(made)
    sent.write.text(str(tmp_path / "in"))
    assert rows(good(decode(text_messages(spark, str(tmp_path / "in"))))) == rows(made)
    binary = sent.selectExpr("CAST(NULL AS binary) AS key", "encode(value, 'UTF-8') AS value")
    assert rows(good(decode(message_values(binary)))) == rows(made)
