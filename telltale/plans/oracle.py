"""The registered queries as plain SQL over the same tables, for DuckDB."""

from __future__ import annotations

from telltale.fixed import CAR_WIDE_COLUMNS
from telltale.plans.queries import (
    AS_OF,
    CAR_METRICS,
    EVENT_RULES,
    EVENT_WIDE_COLUMNS,
    LOOKED_UP,
    WEEK_END,
)

_SECONDS = "%Y%m%d%H%M%S"
_LABEL = "%Y-%m-%d %H:%M:%S"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{field}'" for field in row) + ")" for row in rows)


_READINGS = f"""
readings AS (
    SELECT CAST(event_id AS VARCHAR) AS messageid,
           ts,
           strftime(ts, '{_LABEL}') AS messagedate,
           'U-' || CAST(user_id AS VARCHAR) AS name,
           event_type AS metrics,
           CAST(value AS VARCHAR) AS value
    FROM events
)"""

_RULES = f"""
rules AS (
    SELECT * FROM (VALUES {_values(EVENT_RULES)}) AS r(metrics, value, ent, mod)
)"""


def _int(text: str) -> str:
    return f"CAST(trunc(TRY_CAST({text} AS DOUBLE)) AS INTEGER)"


_OUTCOMES = """
outcomes AS (
    SELECT * FROM (VALUES ('gt', 1), ('lt', -1), ('ltgt', 1), ('ltgt', -1), ('eq', 0)) AS o(mod, side)
)"""


def _matched(where: str = "TRUE", rules: str = "rules", metric: str = "metrics") -> str:
    """Readings and rules whose comparison comes out on a side that the mode raises."""
    return f"""
FROM (SELECT *, {_int("value")} AS seen, {metric} AS watched FROM readings) s
JOIN (SELECT *, {_int("value")} AS bound FROM {rules}) m ON watched = m.metrics
JOIN outcomes o ON o.mod = m.mod AND o.side = sign(seen - bound)
WHERE {where}"""


def _alerts(where: str = "TRUE") -> str:
    return f"""
WITH {_READINGS}, {_RULES}, {_OUTCOMES}
SELECT s.name, m.metrics, m.value {_matched(where)}"""


_DETAIL_COLUMNS = """
s.messageid, s.messagedate, s.name, watched AS metrics, s.value, m.value AS threshold, m.mod"""
_DETAIL = f"WITH {_READINGS}, {_RULES}, {_OUTCOMES} SELECT {_DETAIL_COLUMNS} {_matched()}"
_LARGE = f"""
WITH {_READINGS}, {_OUTCOMES},
large AS (
    SELECT DISTINCT CAST(user_id AS VARCHAR) || '/' || event_type AS metrics,
           CAST(user_id * 7 % 90 AS VARCHAR) AS value,
           CASE user_id % 3 WHEN 0 THEN 'lt' WHEN 1 THEN 'gt' ELSE 'ltgt' END AS mod
    FROM events
)
SELECT {_DETAIL_COLUMNS}
{_matched(rules="large", metric="substr(name, 3) || '/' || metrics")}"""


def _often(where: str = "TRUE") -> str:
    """Names with several readings over the limit of their metric."""
    return f"""
WITH {_READINGS}, {_RULES}
SELECT name, count(*) AS n, CAST(max(seen) AS BIGINT) AS top
FROM (SELECT *, {_int("value")} AS seen FROM readings) s
JOIN (SELECT metrics, {_int("value")} AS bound FROM rules) USING (metrics)
WHERE seen > bound AND {where}
GROUP BY name HAVING count(*) > 1"""

_READING_COLUMNS = "messageid, messagedate, name, metrics, value"
_DECODED = f"WITH {_READINGS} SELECT {_READING_COLUMNS} FROM readings"

_MESSAGE = f"""
CAST(json_object('name', name, 'messageid', messageid,
                 'messagedate', strftime(ts, '{_SECONDS}'),
                 'metrics', metrics, 'value', value) AS VARCHAR)"""


def _spine(start: str, windows: str) -> str:
    return f"""
spine AS (
    SELECT {start} + to_minutes(5 * i) AS w
    FROM range({windows}) AS g(i)
)"""


_RUN_SPINE = _spine(f"(DATE '{AS_OF}' - INTERVAL 1 DAY)", "1000")
_BUCKET = "time_bucket(INTERVAL 300 SECOND, ts)"
_BUCKETED = f"bucketed AS (SELECT *, {_BUCKET} AS b FROM readings)"
_FILL_COLUMNS = f"""
SELECT b.messageid, b.metrics, b.name, b.value, strftime(s.w, '{_LABEL}') AS datewindows"""
_FILL = f"""
WITH {_READINGS}, {_BUCKETED}, {_RUN_SPINE}
{_FILL_COLUMNS}
FROM spine s LEFT JOIN bucketed b ON b.b = s.w"""
_FILL_HISTORY = f"""
WITH {_READINGS}, {_BUCKETED}, {_spine(
    "(SELECT min(b) FROM bucketed)",
    "(SELECT CAST(date_diff('second', min(b), max(b)) / 300 AS BIGINT) + 1 FROM bucketed)",
)}
{_FILL_COLUMNS}
FROM spine s LEFT JOIN bucketed b ON b.b = s.w"""
_COVERAGE = f"""
WITH {_READINGS}, {_BUCKETED}, {_RUN_SPINE}
SELECT strftime(s.w, '{_LABEL}') AS datewindows, count(b.messageid) AS readings
FROM spine s LEFT JOIN bucketed b ON b.b = s.w
GROUP BY s.w"""
_MART = f"""
WITH {_READINGS}, {_BUCKETED}, {_RUN_SPINE}
SELECT strftime(s.w, '{_LABEL}') AS messagedate, b.metrics, b.name, b.value
FROM spine s LEFT JOIN bucketed b ON b.b = s.w"""


def _cells(time: str, readings: str = "readings") -> str:
    return f"""
cells AS (
    SELECT name || '-' || strftime({time}, '{_SECONDS}') AS row_key,
           CASE WHEN metrics LIKE '%driver%' THEN 'driver' ELSE 'car' END AS family,
           metrics AS qualifier, value, ts AS version, messageid
    FROM {readings}
)"""


_CELL_COLUMNS = "row_key, family, qualifier, value"


def _latest(time: str) -> str:
    return f"""
WITH {_READINGS}, {_cells(time)}
SELECT {_CELL_COLUMNS} FROM cells
QUALIFY row_number() OVER (PARTITION BY row_key, family, qualifier
                           ORDER BY version DESC, messageid DESC, value DESC) = 1"""


def _wide(columns, tables: str) -> str:
    picks = ", ".join(
        f"arg_max(value, (version, messageid, value)) "
        f"FILTER (WHERE family = '{fam}' AND qualifier = '{qualifier}') AS {name}"
        for name, fam, qualifier in columns
    )
    kept = _values((fam, qualifier) for _, fam, qualifier in columns)
    return f"""
WITH {tables}
SELECT row_key AS id, {picks} FROM cells
WHERE (family, qualifier) IN ({kept})
GROUP BY row_key"""


_KEYED = f"""
keyed AS (
    SELECT 'U-' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '{_SECONDS}') AS name,
           value AS sugar
    FROM events
)"""
# One row for each key and measure that differ.
_DASHBOARD_STRICT = f"""
WITH {_KEYED}
SELECT substr(key, 1, length(key) - 15) AS name,
       strftime(time_bucket(INTERVAL 300 SECOND, strptime(right(key, 14), '{_SECONDS}')),
                '{_LABEL}') AS swdate,
       sugar
FROM (SELECT DISTINCT name AS key, sugar FROM keyed)"""


def _dashboard_max(tables: str) -> str:
    return f"""
WITH {tables}
SELECT substr(k.name, 1, length(k.name) - 15) AS name,
       strftime(time_bucket(INTERVAL 300 SECOND,
                            strptime(right(k.name, 14), '{_SECONDS}')), '{_LABEL}') AS swdate,
       max(k.sugar) AS sugar
FROM keyed k GROUP BY ALL"""


_KEYED_CELLS = f"""
{_READINGS}, {_cells('ts')},
keyed AS (
    SELECT row_key AS name, CAST(value AS DOUBLE) AS sugar
    FROM (SELECT * FROM cells WHERE qualifier = 'purchase'
          QUALIFY row_number() OVER (PARTITION BY row_key
                                     ORDER BY version DESC, messageid DESC, value DESC) = 1)
)"""


_ARRIVAL = f"""
WITH {_READINGS}, puts AS (
    SELECT 0 AS batch, 'z' || messageid AS id, * FROM readings
    UNION ALL
    SELECT 1, 'a' || messageid, * FROM readings WHERE CAST(messageid AS BIGINT) % 2 = 0
)
SELECT name || '-' || strftime({_BUCKET}, '{_SECONDS}') AS row_key,
       CASE WHEN metrics LIKE '%driver%' THEN 'driver' ELSE 'car' END AS family,
       metrics AS qualifier,
       arg_max(value, (batch, id, value)) AS value
FROM puts GROUP BY ALL"""

_CARS = f"""
{_READINGS},
cars AS (
    SELECT * REPLACE (CASE metrics {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in CAR_METRICS)} END AS metrics)
    FROM readings
)"""

_TWO_RUNS = f"""
WITH {_READINGS}, {_BUCKETED}, {_spine(f"(DATE '{AS_OF}' - INTERVAL 1 DAY)", "1288")}
SELECT strftime(s.w, '{_LABEL}') AS messagedate, b.metrics, b.name, b.value
FROM spine s LEFT JOIN bucketed b ON b.b = s.w"""

_BROKEN = f"""
WITH {_READINGS}
SELECT CASE metrics
         WHEN 'error' THEN '{{bad ' || value
         WHEN 'signup' THEN CAST(json_object('name', name, 'messagedate', strftime(ts, '{_SECONDS}'),
                                             'metrics', metrics, 'value', value) AS VARCHAR)
         ELSE CAST(json_object('name', name, 'messageid', messageid, 'messagedate', '2024-01',
                               'metrics', metrics, 'value', value) AS VARCHAR) END AS raw,
       CASE metrics WHEN 'error' THEN 'not a JSON object'
                    WHEN 'signup' THEN 'member missing'
                    ELSE 'time unreadable' END AS problem
FROM readings WHERE metrics IN ('error', 'signup', 'click')"""


_WEEK = f"s.ts < TIMESTAMP '{WEEK_END}'"
_RERUN = f"WITH {_READINGS}, {_RULES}, {_OUTCOMES} SELECT {_DETAIL_COLUMNS} {_matched(f"m.mod = 'gt' AND {_WEEK}")}"

_MANY = f"""
WITH {_READINGS}, {_OUTCOMES},
many AS (
    SELECT event_type AS metrics,
           CAST(CASE i % 4 WHEN 0 THEN -i WHEN 1 THEN 150 + i ELSE 5 * i END AS VARCHAR) AS value,
           CASE i % 4 WHEN 0 THEN 'lt' WHEN 1 THEN 'gt' ELSE 'eq' END AS mod
    FROM (SELECT DISTINCT event_type FROM events), range(400) AS g(i)
)
SELECT {_DETAIL_COLUMNS} {_matched(rules="many")}"""

_LOOKUP = f"""
SELECT {_CELL_COLUMNS} FROM ({_latest(_BUCKET)}) WHERE starts_with(row_key, '{LOOKED_UP}')"""

_POSITIONS = f"""
WITH {_READINGS}
SELECT name || '-' || strftime({_BUCKET}, '{_SECONDS}') AS row_key,
       CASE WHEN metrics LIKE '%driver%' THEN 'driver' ELSE 'car' END AS family,
       metrics AS qualifier,
       arg_max(value, (date_trunc('minute', ts), CAST(messageid AS BIGINT) % 3, CAST(messageid AS BIGINT))) AS value
FROM readings GROUP BY ALL"""

_MANY_RUNS = f"""
WITH {_READINGS}, {_BUCKETED}, {_spine(f"(DATE '{AS_OF}' - INTERVAL 1 DAY)", "4 * 288 + 1000")}
SELECT strftime(s.w, '{_LABEL}') AS messagedate, b.metrics, b.name, b.value
FROM spine s LEFT JOIN bucketed b ON b.b = s.w"""

# What stays bad after the mending, and what is readable at once or then.
_REPLAY = f"""
WITH {_READINGS}
SELECT messageid, CASE metrics WHEN 'click' THEN '2024-01-01 00:00:00' ELSE messagedate END AS messagedate,
       name, metrics, value, NULL AS raw, NULL AS problem
FROM readings WHERE metrics NOT IN ('error', 'signup')
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, raw, problem FROM ({_BROKEN}) WHERE problem <> 'time unreadable'"""


_ORACLE = {
    "history_rerun": f"{_DECODED} s WHERE {_WEEK}",
    "alerts_rerun": _RERUN,
    "history_catalog": f"""{_DECODED}
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'""",
    "history_vacuumed": _DECODED,
    "quarantine_replay": _REPLAY,
    "cells_snapshot": _latest(_BUCKET),
    "cells_lookup": _LOOKUP,
    "cells_positions": _POSITIONS,
    "alerts_many_thresholds": _MANY,
    "alerts_rule_guarded": _often(),
    "mart_many_runs": _MANY_RUNS,
    "alerts": _alerts(),
    "alerts_detail": _DETAIL,
    "alerts_gt": _alerts("m.mod = 'gt'"),
    "alerts_lt": _alerts("m.mod = 'lt'"),
    "alerts_eq": _alerts("m.mod = 'eq'"),
    "alerts_large_rules": _LARGE,
    "alerts_sql_rule": _often(),
    "alerts_rules_csv": _alerts(),
    "alerts_rules_delimited": _alerts(),
    "alerts_rules_table": _alerts(),
    "alerts_stream": _DETAIL,
    "alerts_once": _often("s.metrics NOT IN ('error', 'click', 'signup')"),
    "once_quarantine": _BROKEN,
    "inbox_view": _DECODED,
    "decode_readings": _DECODED,
    "decode_minutes": f"""
WITH {_READINGS}
SELECT messageid, strftime(date_trunc('minute', ts), '{_LABEL}') AS messagedate,
       name, metrics, value
FROM readings""",
    "decode_quarantine": _BROKEN,
    "decode_text_files": _DECODED,
    "reading_messages": f"WITH {_READINGS} SELECT {_MESSAGE} AS value FROM readings",
    "event_props": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "window_fill": _FILL,
    "window_fill_nonempty": f"{_FILL} WHERE b.messageid IS NOT NULL",
    "window_fill_history": _FILL_HISTORY,
    "window_coverage": _COVERAGE,
    "mart_scan": _MART,
    "mart_two_runs": _TWO_RUNS,
    "cells": f"WITH {_READINGS}, {_cells('ts')} SELECT {_CELL_COLUMNS} FROM cells",
    "cells_one_metric": f"""
WITH {_READINGS}, {_cells('ts')} SELECT {_CELL_COLUMNS} FROM cells WHERE qualifier = 'view'""",
    "cells_latest": _latest(_BUCKET),
    "cells_wide": _wide(EVENT_WIDE_COLUMNS, f"{_READINGS}, {_cells(_BUCKET)}"),
    "cells_arrival": _ARRIVAL,
    "cells_wide_cars": _wide(CAR_WIDE_COLUMNS, f"{_CARS}, {_cells(_BUCKET, 'cars')}"),
    "cells_stream": _latest("ts"),
    "dashboard_strict": _DASHBOARD_STRICT,
    "dashboard_max": _dashboard_max(_KEYED),
    "dashboard_cells": _dashboard_max(_KEYED_CELLS),
    "dashboard_max_stream": _dashboard_max(_KEYED),
    "reading_count": "SELECT count(*) AS n FROM events",
    "peek": f"""
WITH {_READINGS}
SELECT {_READING_COLUMNS} FROM readings ORDER BY ts, messageid, metrics LIMIT 10""",
    "csv_quoted_roundtrip": "SELECT event_id, user_id, event_type, value, props FROM events",
    "partitioned_roundtrip": f"""
WITH {_READINGS}
SELECT {_READING_COLUMNS}, strftime(ts, '%Y-%m-%d') AS event_date FROM readings""",
    "history_append": f"{_DECODED} UNION ALL SELECT {_READING_COLUMNS} FROM readings",
    "history_archive": _DECODED,
    "history_archive_late": _DECODED,
    "history_stream": _DECODED,
}


def statements() -> dict[str, str]:
    return dict(_ORACLE)
