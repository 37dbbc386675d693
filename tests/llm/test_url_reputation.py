import pytest

from telltale.llm import url_reputation as urls
from telltale.llm.queries import URL_RULES

PAGES = "page_id long, url string, host string, rule string, n long"


@pytest.fixture
def make_pages(spark):
    return lambda rows: spark.createDataFrame([(i, u, "h", "r", 1) for i, u in rows], PAGES)


@pytest.fixture
def make_outcomes(spark):
    return lambda rows: spark.createDataFrame(rows, "page_id long, good int")


def test_rules(make_pages, make_outcomes):
    cases = {
        "https://Blog.Example.COM/en/1?q#f": ("blog.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://a.www.example.com/en/x": ("a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://example.com?x=/en/": ("example.com", "", None, "allow"),
        "x://b.net/fr/2#y://c": ("b.net", "/fr/2", "net/fr/", "block"),
        "http://net/es/": ("net", "/es/", "net/es/", "block"),
        "no scheme.com/en/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://É.net/\nES/": ("É.net", "/\nES/", None, "allow"),
    }
    rows = list(enumerate(cases))
    found = urls.judge_urls(make_pages([*rows, rows[0]]), URL_RULES, make_outcomes([])).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        expected = list(cases.values())[r["page_id"]]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == expected


def test_reputation(make_pages, make_outcomes):
    """A host with many bad pages is blocked, one with a single bad page is not."""
    rows, outcomes = [], []
    for k in range(400):
        host = ["bad.spam.org", "fine.good.org", f"h{k}.good.org", "b.co.uk"][k % 4]
        rows.append((k, f"http://{host}/{k}"))
        outcomes.append((k, int(k % 4 != 0)))
    rows += [(1000, "http://once.good.org/"), (1001, "http://bad.spam.org/new"), (1002, "http://new.org/")]
    outcomes += [(1000, 0), (None, 0), (1001, None), (1002, 7)]
    found = urls.judge_urls(make_pages(rows), [], make_outcomes(outcomes)).collect()
    blocked = {r["host"] for r in found if r["verdict"] == "block"}
    assert blocked == {"bad.spam.org"}
    assert next(r for r in found if r["page_id"] == 1001)["verdict"] == "block"


def test_shrinkage(make_pages, make_outcomes):
    rows = [(k, f"http://h{k % 9}.d.org/") for k in range(90)] + [(90, "http://x.d.org/")]
    pages = make_pages(rows).select("page_id", *[c.alias(n) for c, n in zip(urls.url_parts(urls.F.col("url")), ["host", "path"])])
    domain, suffix = urls.name_levels(urls.F.col("host"))
    pages = pages.withColumns({"domain": domain, "suffix": suffix})
    outcomes = make_outcomes([(k, int(k % 9 < 8)) for k in range(90)] + [(90, 0)])
    found = {r["host"]: r for r in urls.host_reputation(pages, outcomes).collect()}
    assert found["h8.d.org"]["rate"] < found["x.d.org"]["rate"] < found["h0.d.org"]["rate"]
    assert 0 < found["h8.d.org"]["rate"] < found["h8.d.org"]["upper"]


def test_empty(make_pages, make_outcomes):
    assert urls.judge_urls(make_pages([]), URL_RULES, make_outcomes([(1, 1)])).collect() == []
