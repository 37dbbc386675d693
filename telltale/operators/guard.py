"""A user's rule text, looked at before any of it runs.

The text is parsed, which runs nothing, and the tree is walked: it has to be one query
made of known kinds of nodes, over the views it was given. Then the plan that Spark
would run is searched for products of tables.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

# Relations and operators that a query may consist of. Commands, scripts and functions that
# make tables are not among them.
_ALLOWED = frozenset(
    {
        "Aggregate", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "Intersect", "Join",
        "LocalLimit", "LocalRelation", "OneRowRelation", "Project", "Sort", "SubqueryAlias",
        "Union", "UnresolvedHaving", "UnresolvedInlineTable", "UnresolvedRelation",
        "UnresolvedSubqueryColumnAliases", "UnresolvedWith", "Window", "WithWindowDefinition",
    }
)
# Of what is unresolved, these are values and not relations.
_VALUES = frozenset(
    {
        "UnresolvedAlias", "UnresolvedAttribute", "UnresolvedExtractValue", "UnresolvedFunction",
        "UnresolvedGenerator", "UnresolvedOrdinal", "UnresolvedStar",
    }
)
# Functions that call code of the machine.
_FOREIGN = frozenset({"java_method", "reflect", "try_reflect"})
_PRODUCTS = ("CartesianProduct", "BroadcastNestedLoopJoin")


class RefusedRule(ValueError):
    """A rule text that is not run."""


def check_text(spark: SparkSession, text: str, views: Iterable[str]) -> None:
    """Refuse a text that is not one query over ``views``; nothing of it runs."""
    views = sorted(views)
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except ParseException as wrong:
        raise RefusedRule(f"not one SQL query: {wrong}") from wrong
    _check(json.loads(parsed.toJSON()), frozenset(v.lower() for v in views), views)


def _check(found, names: frozenset[str], views: list[str]) -> None:
    """Walk what Spark writes of a tree: lists of nodes, whose fields may hold trees again."""
    if isinstance(found, list):
        if found and isinstance(found[0], dict) and found[0].get("class", "").endswith(".UnresolvedWith"):
            # What it names is known below it and nowhere else.
            names = names | frozenset(_named(found[0]["cteRelations"]))
        for part in found:
            _check(part, names, views)
    elif isinstance(found, dict):
        if "class" in found:
            _check_node(found, names, views)
        for part in found.values():
            _check(part, names, views)


def _check_node(node: dict, names: frozenset[str], views: list[str]) -> None:
    package, _, kind = node["class"].rpartition(".")
    if kind == "UnresolvedRelation":
        asked = [p.strip() for p in node["multipartIdentifier"].strip("[]").split(",")]
        if len(asked) != 1 or asked[0].lower() not in names:
            raise RefusedRule(f"{'.'.join(asked)}: a rule reads {' and '.join(views)} only")
    elif kind == "UnresolvedFunction":
        said = json.dumps(node.get("nameParts", "")).lower()
        if any(f in said for f in _FOREIGN):
            raise RefusedRule("a rule calls functions of SQL only")
    elif not (".expressions" in package or kind in _VALUES or kind in _ALLOWED):
        raise RefusedRule(f"{kind} is not allowed in a rule, which is one query")


def _named(relations) -> Iterator[str]:
    """The names that a WITH clause gives, but not those of aliases inside its queries."""
    if isinstance(relations, dict):
        if relations.get("class", "").endswith(".SubqueryAlias"):
            yield relations["identifier"]["name"].lower()
        else:
            for part in relations.values():
                yield from _named(part)
    elif isinstance(relations, list):
        first = relations[:1] if relations and isinstance(relations[0], dict) else relations
        for part in first:
            yield from _named(part)


def check_plan(frame: DataFrame) -> None:
    """Refuse a query whose plan makes all pairs of two tables."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    if any(p in plan for p in _PRODUCTS):
        raise RefusedRule("a rule joins its tables on equal columns, not every row with every row")
