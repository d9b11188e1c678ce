import pytest

from adsift.llm import urls

PAGES = [
    ("http://a.NET/x?y", "a.net", "/x", "net/", "block"),
    ("http://net", "net", "", None, "allow"),
    ("http://net/", "net", "/", "net/", "block"),
    ("https://www.example.net/en/1#t", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://example.net/EN/1", "example.net", "/EN/1", "net/", "block"),
    ("https://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("ftp://m.example.com/de/", "m.example.com", "/de/", "example.com/de/", "block"),
    ("ftp://m.example.com/de", "m.example.com", "/de", None, "allow"),
    ("http://x.org/fr/a", "x.org", "/fr/a", "org/fr/", "allow"),
    ("http://x.org:80/fr/a", "x.org:80", "/fr/a", None, "allow"),
    ("http://a..net/q", "a..net", "/q", "net/", "block"),
    ("no scheme.net/", "", "", None, "allow"),
    ("a://b.net://c.de/", "b.net:", "//c.de/", None, "allow"),
    ("://net/x", "net", "/x", "net/", "block"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://" + "a." * 5000 + "net/" + "p" * 5000, "a." * 5000 + "net", "/" + "p" * 5000, "net/", "block"),
]


def test_every_form(spark):
    rows = [(i, p[0], "clash", 1) for i, p in enumerate(PAGES)] + [(0, PAGES[0][0], "clash", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, Host string, digest int")
    out = sorted(urls.judge(pages, urls.rule_table(spark)).collect(), key=lambda r: r["page_id"])
    assert len(out) == len(rows)
    for r in out:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == PAGES[r["page_id"]][1:], r["page_id"]


def test_precedence_and_empty_tables(spark):
    rules = urls.rule_table(spark, [("b.c/x", "allow"), ("c/x/y", "block"), ("a.b.c/x", "block"), ("c/", "allow")])
    pages = spark.createDataFrame([(1, "h://a.b.c/xyz"), (2, "h://z.b.c/x"), (3, "h://c/x/y"), (4, "h://q.c/k")], "page_id long, url string")
    out = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, rules).collect()}
    assert out == {1: ("a.b.c/x", "block"), 2: ("b.c/x", "allow"), 3: ("c/x/y", "block"), 4: ("c/", "allow")}
    assert urls.judge(pages.limit(0), rules).collect() == []
    none = urls.judge(pages, urls.rule_table(spark, [("x", "block")]), default="block").collect()
    assert {r["verdict"] for r in none} == {"block"} and len(none) == 4


@pytest.mark.parametrize("short", [0, 8])
def test_short_hashes_are_confirmed(spark, monkeypatch, short):
    monkeypatch.setattr(urls, "PREFIX_HEX", short)  # 0: every expression meets every rule
    pages = spark.createDataFrame([(1, "h://a.com/de/"), (2, "h://b.net/q")], "page_id long, url string")
    out = {r["page_id"]: r["rule"] for r in urls.judge(pages, urls.rule_table(spark)).collect()}
    assert out == {1: None, 2: "net/"}


def test_the_join_key_is_the_short_prefix(spark):
    """Full digests are no part of the join: different rules with equal prefixes meet every expression of that prefix."""
    pages = spark.createDataFrame([(1, "h://a.com/de/"), (2, "h://b.net/q")], "page_id long, url string")
    out = urls.judge(pages, urls.rule_table(spark))
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x and "known" in x]
    assert len(joins) == 1 and joins[0].count("=") == 1 and "short" in joins[0] and "digest" not in joins[0] and "sha2" not in joins[0]
