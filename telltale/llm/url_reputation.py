"""URL rules, and for the other pages the reputation of their host."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Suffixes of more than one label below which names are registered. A caller
# passes the list of its own corpus.
LONG_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")

MIN_GOOD = 0.5
Z = 1.96


class UrlRule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rule(line: str) -> UrlRule:
    """``block example.com/en/``: a verdict, a host and the beginning of a path."""
    verdict, place = line.split()
    host, slash, rest = place.partition("/")
    return UrlRule(verdict, host, slash + rest)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in small A-Z and path. A NULL, or no ``://``, gives two empty texts."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(whole, pattern, 1), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(whole, pattern, 2)


def rule_choice(rules: Iterable[UrlRule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or NULL.

    The rules are a list that somebody wrote, so they are an expression and not
    a table. Of two equally long rules the one with the longer host wins.
    """
    chosen, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        at_host = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = at_host & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, F.lit(rule.text)).otherwise(chosen)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return chosen, verdict


def name_levels(host: Column, long_suffixes: Iterable[str] = LONG_SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host name."""
    two = F.substring_index(host, ".", -2)
    is_long = two.isin(*long_suffixes)
    suffix = F.when(is_long, two).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(is_long, F.substring_index(host, ".", -3)).otherwise(two)
    return domain, suffix


def _strength(counts: DataFrame, parent: list[str]) -> DataFrame:
    """How much members of a group agree, as the weight of the prior of that level.

    Method of moments over all groups of the level: the spread of the rates
    around their group beyond what chance explains. One row.
    """
    groups = counts.groupBy(*parent).agg(
        F.sum("n").alias("gn"),
        F.sum("good").alias("gk"),
        F.sum(F.col("n") * F.col("n")).alias("gn2"),
        F.sum(F.col("good") * F.col("good") / F.col("n")).alias("kk"),
        F.count("*").alias("m"),
    )
    p = F.col("gk") / F.col("gn")
    chance = p * (1 - p)
    within = F.col("kk") - F.col("gk") * p
    size = F.col("gn") - F.col("gn2") / F.col("gn") - (F.col("m") - 1)
    sums = groups.agg(
        F.sum(within - (F.col("m") - 1) * chance).alias("extra"),
        F.sum(size * chance).alias("room"),
    )
    share = F.col("extra") / F.col("room")
    known = F.coalesce(F.when(F.col("room") > 0, share), F.lit(0.0))
    kept = F.least(F.greatest(known, F.lit(0.001)), F.lit(0.5))
    return sums.select(F.round(1 / kept - 1, 6).alias("weight"))


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Posterior of the share of good pages of every host with a labelled page.

    ``pages(page_id, host, domain, suffix)``, ``outcomes(page_id, good)`` with
    good 0 or 1; other values and NULLs are not outcomes. The rate of a host is
    shrunk towards its registered domain, that one towards its suffix, and the
    suffix towards the whole. ``upper`` is the upper end of the posterior, ``Z``
    standard deviations above its mean.
    """
    seen = outcomes.where(F.col("good").isin(0, 1)).select(
        "page_id", F.col("good").cast("long").alias("good")
    )
    # Hosts are summed in the tasks, so a host with a third of the pages is one row each.
    hosts = (
        pages.join(seen, "page_id")
        .groupBy("suffix", "domain", "host")
        .agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    )
    sums = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    whole = suffixes.agg(F.sum("n").alias("all_n"), F.sum("good").alias("all_good"))
    # Each of these is one row.
    weights = (
        whole.join(F.broadcast(_strength(suffixes, [])).withColumnRenamed("weight", "w_suffix"))
        .join(F.broadcast(_strength(domains, ["suffix"])).withColumnRenamed("weight", "w_domain"))
        .join(F.broadcast(_strength(hosts, ["suffix", "domain"])).withColumnRenamed("weight", "w_host"))
    )
    at_suffix = suffixes.join(F.broadcast(weights)).select(
        "suffix", "w_domain", "w_host",
        _shrunk(F.col("all_good") / F.col("all_n"), F.col("w_suffix")).alias("suffix_rate"),
    )
    at_domain = domains.join(at_suffix, "suffix").select(
        "suffix", "domain", "w_host", _shrunk(F.col("suffix_rate"), F.col("w_domain")).alias("domain_rate")
    )
    rate = _shrunk(F.col("domain_rate"), F.col("w_host"))
    spread = F.sqrt(rate * (1 - rate) / (F.col("w_host") + F.col("n") + 1))
    return hosts.join(at_domain, ["suffix", "domain"]).select(
        "host", "n", "good", rate.alias("rate"), (rate + Z * spread).alias("upper")
    )


def _shrunk(prior: Column, weight: Column) -> Column:
    return (prior * weight + F.col("good")) / (weight + F.col("n"))


def judge_urls(
    pages: DataFrame,
    rules: Iterable[UrlRule],
    outcomes: DataFrame,
    min_good: float = MIN_GOOD,
    long_suffixes: Iterable[str] = LONG_SUFFIXES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url)``.

    The longest fitting rule decides. Without one a page is blocked if even the
    upper end of its host's posterior lies below ``min_good``; hosts without
    outcomes, and pages without a host, are allowed. Other columns are left out.
    """
    host, path = url_parts(F.col("url"))
    named = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_choice(rules, F.col("host"), F.col("path"))
    ruled = named.withColumns({"rule": rule, "ruled": verdict})
    domain, suffix = name_levels(F.col("host"), long_suffixes)
    known = named.where("host <> ''").select(
        "page_id", "host", domain.alias("domain"), suffix.alias("suffix")
    )
    bad = host_reputation(known, outcomes).where(F.col("upper") < min_good)
    blocked = bad.select("host", F.lit("block").alias("found"))
    return ruled.join(blocked, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", "found", F.lit("allow")).alias("verdict"),
    )
