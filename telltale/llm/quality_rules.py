"""Quality rules whose thresholds come from the data of each language and source.

Everything is DataFrame functions: no Python runs in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telltale.llm.tasks import WORD_BREAK_PATTERN, WORD_BREAKS, stored

SYMBOLS = "#*$%&|<>"

# What is judged, in thousandths: (name, numerator, denominator, slack, also from below).
# The slack is the smallest distance from the quartiles that counts as far.
METRICS = (
    ("word_length", "word_chars", "n_words", 1000, True),
    ("symbols", "n_symbols", "n_words", 100, False),
    ("dup_lines", "n_dup_lines", "n_lines", 500, False),
    ("repeat_words", "n_repeat_words", "n_words", 400, False),
)
FENCE = 6
# A quartile counts at most so many times as far from the median as the nearer one.
SKEW = 2
MIN_DOCS = 200
# A value keeps so many leading binary digits, which is a relative error of 1/64.
DIGITS = 7


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, x: total + x)


def text_facts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that the rules judge; a NULL text counts as an empty one.

    ``n_repeat_words`` counts the words that lie in a window of three words found
    twice or more in the text. Windows are sorted by digest inside the row, so a
    long text costs no more than its length times a logarithm, and nothing is
    shuffled. Columns of the same names are replaced, all others are kept.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    plain = F.length(F.translate(body, WORD_BREAKS, ""))
    facts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
    kept = [c for c in docs.columns if c not in facts]
    # One projection per step: a value that is used twice is not computed twice.
    step = docs.select(
        *kept,
        F.array_remove(F.split(body, WORD_BREAK_PATTERN), "").alias("__words"),
        lines.alias("__lines"),
        plain.cast("bigint").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    n = F.size("__words")
    triple = F.arrays_zip(
        F.col("__words").alias("a"),
        F.slice("__words", F.lit(2), n).alias("b"),
        F.slice("__words", F.lit(3), n).alias("c"),
    )
    triples = F.slice(triple, F.lit(1), F.greatest(n - 2, F.lit(0)))

    def placed(x: Column, i: Column) -> Column:
        digest = F.xxhash64(x.getField("a"), x.getField("b"), x.getField("c"))
        return F.struct(digest.alias("h"), i.alias("i"))

    windows = F.transform(triples, placed)
    return _covered(
        step.select(
            *kept,
            "word_chars",
            "n_symbols",
            n.cast("bigint").alias("n_words"),
            F.size("__lines").cast("bigint").alias("n_lines"),
            (F.size("__lines") - F.size(F.array_distinct("__lines")))
            .cast("bigint")
            .alias("n_dup_lines"),
            F.array_sort(windows).alias("__windows"),
        ),
        kept,
    )


def _covered(step: DataFrame, kept: list[str]) -> DataFrame:
    """Words covered by windows that have an equal neighbour in digest order."""
    plain = [*kept, "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines"]
    n = F.size("__windows")
    same = F.zip_with(
        "__windows",
        F.slice("__windows", F.lit(2), n),
        lambda a, b: F.coalesce(a.getField("h") == b.getField("h"), F.lit(False)),
    )
    step = step.select(*plain, "__windows", same.alias("__same"))
    flagged = F.zip_with(
        F.zip_with("__windows", "__same", lambda w, s: F.struct(w.getField("i").alias("i"), s.alias("s"))),
        F.concat(F.array(F.lit(False)), F.col("__same")),
        lambda w, before: F.when(w.getField("s") | before, w.getField("i")),
    )
    step = step.select(*plain, F.array_sort(F.array_compact(flagged)).alias("__at"))
    gaps = F.zip_with(
        "__at",
        F.slice("__at", F.lit(2), F.size("__at")),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)),
    )
    return step.select(*plain, _sum(gaps).alias("n_repeat_words"))


def base_failed() -> Column:
    """The fixed rules: under 50 words, or more than half of the words repeated."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def metric_value(top: str, bottom: str) -> Column:
    """A ratio in whole thousandths; 0 where there is nothing to divide by."""
    return F.when(F.col(bottom) > 0, F.floor(F.expr(f"1000 * {top} div {bottom}"))).otherwise(0)


def sketch(facts: DataFrame, *groups: str) -> DataFrame:
    """Mergeable quantile sketches: counts of documents by leading digits of a value.

    One row per group, metric and bucket. Two sketches are merged by adding the
    counts of equal buckets. ``low`` is the smallest value of a bucket.
    """
    values = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), metric_value(a, b).alias("value"))
            for name, a, b, _, _ in METRICS
        ]
    )
    rows = facts.select(*groups, F.inline(values))
    cut = F.greatest(F.length(F.bin("value")) - DIGITS, F.lit(0))
    low = F.call_function(
        "shiftleft", F.call_function("shiftright", F.col("value"), cut), cut
    )
    return rows.groupBy(*groups, "metric", low.alias("low")).agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, *groups: str) -> DataFrame:
    return sketches.groupBy(*groups, "metric", "low").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, *groups: str) -> DataFrame:
    """Lower and upper bound of every metric of a group, and the documents behind it.

    The bounds lie ``FENCE`` times the distance of the quartiles, or the slack
    of the metric if that is more, outside the quartiles. Junk in more than a
    quarter of a group is a quartile of it. While it is less than half, the
    median and a quartile are not, so no quartile counts further than ``SKEW``
    times the distance of the nearer one, and a bucket, from the median.
    """
    part = Window.partitionBy(*groups, "metric")
    ranked = sketches.select(
        *groups,
        "metric",
        "low",
        F.sum("n").over(part.orderBy("low")).alias("upto"),
        F.sum("n").over(part).alias("docs"),
    )
    quartiles = ranked.groupBy(*groups, "metric").agg(
        F.max("docs").alias("docs"),
        F.min(F.when(4 * F.col("upto") >= F.col("docs"), F.col("low"))).alias("q1"),
        F.min(F.when(2 * F.col("upto") >= F.col("docs"), F.col("low"))).alias("q2"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("docs"), F.col("low"))).alias("q3"),
    )
    cut = F.greatest(F.length(F.bin("q2")) - DIGITS, F.lit(0))
    bucket = F.call_function("shiftleft", F.lit(1).cast("bigint"), cut)
    nearer = F.least(F.col("q2") - F.col("q1"), F.col("q3") - F.col("q2"))
    reach = SKEW * (nearer + bucket)
    quartiles = quartiles.select(
        *groups,
        "metric",
        "docs",
        F.greatest("q1", F.col("q2") - reach).alias("q1"),
        F.least("q3", F.col("q2") + reach).alias("q3"),
    )
    slack = F.lit(0)
    for name, _, _, s, _ in METRICS:
        slack = F.when(F.col("metric") == name, s).otherwise(slack)
    far = F.greatest(FENCE * (F.col("q3") - F.col("q1")), slack)
    return quartiles.groupBy(*groups).agg(
        F.max("docs").alias("docs"),
        *[
            F.max(F.when(F.col("metric") == name, F.col("q3") + far)).alias(f"{name}_high")
            for name, *_ in METRICS
        ],
        *[
            F.max(F.when(F.col("metric") == name, F.col("q1") - far)).alias(f"{name}_low")
            for name, _, _, _, below in METRICS
            if below
        ],
    )


def _bounds() -> list[str]:
    return [f"{name}_high" for name, *_ in METRICS] + [
        f"{name}_low" for name, _, _, _, below in METRICS if below
    ]


def thresholds(facts: DataFrame) -> DataFrame:
    """Bounds for every ``(lang, source)``, learnt from documents that pass the fixed rules.

    A group of fewer than ``MIN_DOCS`` takes those of its language, and that one
    those of the whole corpus. Sketches of the wider groups are merged from the
    narrow ones, so the documents are counted once.
    """
    narrow = sketch(facts.where(~base_failed()), "lang", "source")
    by_source = fences(narrow, "lang", "source")
    by_lang = fences(merged(narrow, "lang"), "lang")
    everywhere = fences(merged(narrow))
    groups = facts.select("lang", "source").distinct()
    levels = (
        groups.join(_named(by_source, "s"), ["lang", "source"], "left")
        .join(_named(by_lang, "l"), ["lang"], "left")
        # One row at most.
        .join(F.broadcast(_named(everywhere, "a")), how="left")
    )
    chosen = [
        F.when(F.col("s_docs") >= MIN_DOCS, F.col(f"s_{b}"))
        .when(F.col("l_docs") >= MIN_DOCS, F.col(f"l_{b}"))
        .otherwise(F.col(f"a_{b}"))
        .alias(b)
        for b in _bounds()
    ]
    return levels.select("lang", "source", *chosen)


def _named(bounds: DataFrame, lead: str) -> DataFrame:
    return bounds.select(
        *[F.col(c).alias(f"{lead}_{c}" if c == "docs" or c in _bounds() else c) for c in bounds.columns]
    )


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``.

    ``docs`` holds ``doc_id, text, lang, source``; other columns are left out. A
    missing language or source counts as an empty one. A document is kept if it
    passes the fixed rules and no metric lies outside the bounds of its group.
    Repeated rows are judged each; an empty table gives no rows.
    """
    named = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        "text",
    )
    facts = stored(text_facts(named).drop("text"), "quality-facts")
    outside = F.lit(False)
    for name, a, b, _, below in METRICS:
        value = metric_value(a, b)
        outside = outside | (value > F.coalesce(F.col(f"{name}_high"), value))
        if below:
            outside = outside | (value < F.coalesce(F.col(f"{name}_low"), value))
    return facts.join(thresholds(facts), ["lang", "source"], "left").select(
        "doc_id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & ~outside).alias("kept"),
    )
