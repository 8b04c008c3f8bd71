from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowgauge.llm import url_filter

PAGES = [
    (1, "http://a.example.com/en/1", None),
    (2, "https://WWW.Example.com/en/x?y#z", ""),
    (3, "http://www.example.com", ""),
    (4, "http://x.net/fr/1", ""),
    (5, None, ""),
    (6, "no address", ""),
    (7, "http://b.org/page", '<head><LINK href="http://x.net/fr/1#top" rel="canonical"></head>'),
    (8, "http://c.org/a/b", "<link rel=canonical href=../q><meta http-equiv='refresh' content='0; url=http://b.org/page'>"),
    (9, "http://d.org/1", '<link rel="canonical" href="http://www.example.com/en/only">'),
    (10, "http://d.org/2", '<link rel="canonical" href="//x.net/es/only">'),
    (11, "http://d.org/3", '<link rel="canonical" href="/1">'),
    (12, "http://e.org/", '<link rel="canonical" href="http://x.net/es/gone">'),
    (13, "http://e.org/", '<link rel="stylesheet" href="http://x.net/es/gone">'),
    (14, "http://f.org:80/x//y", "<p>" * 50_000),
    (15, "http://net/es/1", ""),
    (16, "http://fakeexample.com/en/", ""),
    (17, "http://g.org/", '<link rel="canonical" href="http://x.net/es/g">'),
    (18, "http://h.com/x", '<link rel="canonical" href="http://g.org/">'),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, node string, found int")


def test_rules_and_aliases(pages):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.url_verdicts(pages).collect()}
    assert got == {
        1: ("a.example.com", "/en/1", "example.com/en/", "block"),
        2: ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        3: ("www.example.com", "", None, "allow"),
        4: ("x.net", "/fr/1", "net/fr/", "block"),
        5: ("", "", None, "allow"),
        6: ("", "", None, "allow"),
        7: ("b.org", "/page", None, "block"),
        8: ("c.org", "/a/b", None, "block"),
        9: ("d.org", "/1", None, "allow"),
        10: ("d.org", "/2", None, "block"),
        11: ("d.org", "/3", None, "allow"),
        12: ("e.org", "/", None, "block"),
        13: ("e.org", "/", None, "block"),
        14: ("f.org:80", "/x//y", None, "allow"),
        15: ("net", "/es/1", "net/es/", "block"),
        16: ("fakeexample.com", "/en/", "com/", "allow"),
        17: ("g.org", "/", None, "allow"),
        18: ("h.com", "/x", "com/", "allow"),
    }


def test_given_redirects_and_repeats(spark, pages):
    moved = spark.createDataFrame([("http://F.org:80/x//y", "http://q.net/es/"), (None, "x")], "a string, b string")
    twice = pages.unionByName(pages)
    got = url_filter.url_verdicts(twice, redirects=moved).where("page_id = 14").collect()
    assert [r.verdict for r in got] == ["block", "block"]


def test_no_pages(pages):
    assert url_filter.url_verdicts(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("link", "want"),
    [
        ("http://o.org/x", "http://o.org/x"), ("//o.org/x", "https://o.org/x"), ("/r", "https://h.org/r"),
        ("s", "https://h.org/a/s"), ("?q", "https://h.org/a/b?q"), ("#f", "https://h.org/a/b?c#d"), ("mailto:x", "mailto:x"),
    ],
)
def test_links_are_made_absolute(spark, link, want):
    row = spark.range(1).select(url_filter.resolved(F.lit("https://h.org/a/b?c#d"), F.lit(link)).alias("r")).first()
    assert row.r == want


def test_plan_is_native(pages):
    plan = url_filter.url_verdicts(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
