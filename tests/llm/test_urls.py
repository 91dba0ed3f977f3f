import pytest
from pyspark.sql import functions as F

from tidemark.llm import urls

CANONICAL = '<html><head><link {0}></head></html>'


def judged(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.verdicts(df, **options).collect()}


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://WWW.Example.NET/en/x?q#f", "www.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
    ("http://a.example.com/de/1", "a.example.com", "/de/1", "example.com/de/", "block"),
    ("http://example.com/de", "example.com", "/de", None, "allow"),
    ("https://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
    ("http://x.net", "x.net", "", None, "allow"), ("http://x.net?a=/b", "x.net", "", None, "allow"),
    ("x.net/a", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("http://h/p://net/x#", "h", "/p://net/x", None, "allow"), ("http://", "", "", None, "allow"),
])
def test_rules(spark, url, host, path, rule, verdict):
    assert judged(spark, [(1, url, None)]) == {1: (host, path, rule, verdict)}


def test_blocks_reach_aliases_and_explicit_allow_holds(spark):
    rows = [
        (1, "http://a.org/x", CANONICAL.format('rel="canonical" href="http://b.org/y"')),
        (2, "http://b.org/y#part", "<meta http-equiv='refresh' content='0; url=http://c.org/z'>"),
        (3, "http://c.org/z", CANONICAL.format("href=http://bad.net/1 rel=canonical")),  # blocked, and no page here
        (4, "http://d.org/fr/1", CANONICAL.format('rel="canonical" href="http://c.org/z"')),  # explicitly allowed
        (5, "http://e.org/x", CANONICAL.format('rel="canonical" href="http://f.org/"')),
        (6, "http://f.org/", "<p>link rel=canonical href=http://bad.net/1</p>"),
        (7, "http://A.ORG/x", None), (8, None, CANONICAL.format('rel="canonical" href="http://bad.net/1"')),
    ]
    got = {k: v[3] for k, v in judged(spark, rows).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "allow"}
    table = spark.createDataFrame([("http://f.org/", "http://bad.net/2"), (None, "http://a.org/x")], "a string, b string")
    got = {k: v[3] for k, v in judged(spark, rows, redirects=table).items()}
    assert got[5] == got[6] == "block" and got[8] == "allow"


def test_relative_links(spark):
    base = F.lit("http://h.org/a/b?c/d#e")
    want = {"x": "http://h.org/a/x", "/x": "http://h.org/x", "//i.org/x": "http://i.org/x", "ftp://j/x": "ftp://j/x"}
    row = spark.range(1).select(*[urls.resolved(base, F.lit(k)).alias(str(i)) for i, k in enumerate(want)]).first()
    assert list(row) == list(want.values())


def test_links_name_the_address_they_resolve_to(spark):
    """The reference list of relative links of the URI standard, with folders and dots."""
    base = F.lit("http://A.org/b/c/d;p?q")
    want = {
        "g": "/b/c/g", "./g": "/b/c/g", "g/": "/b/c/g/", "/g": "/g", "?y": "/b/c/d;p?y", "g?y": "/b/c/g?y", "#s": "/b/c/d;p?q",
        "g#s": "/b/c/g", "g?y#s": "/b/c/g?y", ";x": "/b/c/;x", ".": "/b/c/", "./": "/b/c/", "..": "/b/", "../": "/b/",
        "../g": "/b/g", "../..": "/", "../../g": "/g", "../../../g": "/g", "/./g": "/g", "/../g": "/g", "g.": "/b/c/g.",
        "..g": "/b/c/..g", "./../g": "/b/g", "./g/.": "/b/c/g/", "g/./h": "/b/c/g/h", "g/../h": "/b/c/h", "g?y/../x": "/b/c/g?y/../x",
        "//a.org": "/", "HTTP://a.org?x": "/?x",
    }
    row = spark.range(1).select(*[urls.node_of(urls.resolved(base, F.lit(k))).alias(str(i)) for i, k in enumerate(want)]).first()
    assert list(row) == ["http://a.org" + v for v in want.values()]
    odd = ["mailto:x@y", "x/../y", "", None, "http://", "http://a.org/x//../y"]
    df = spark.createDataFrame([(u,) for u in odd], "u string")
    assert [r[0] for r in df.select(urls.node_of(F.col("u"))).collect()] == ["mailto:x@y", "x/../y", "", None, "http:///", "http://a.org/x/y"]


def test_blocks_reach_aliases_by_relative_links(spark):
    link = CANONICAL.format
    rows = [
        (1, "http://a.org/x/y.html", link('rel="canonical" href="../z.html"')), (2, "http://a.org/z.html", link('rel=canonical href="?p=2"')),
        (3, "http://a.org/z.html?p=2", link('rel=canonical href="http://bad.net/"')), (4, "http://c.org", link('rel=canonical href="http://d.net/./"')),
        (5, "http://c.org/", None), (6, "http://c.org/#top", None), (7, "http://c.org/other", None),
    ]
    assert {k: v[3] for k, v in judged(spark, rows).items()} == dict.fromkeys(range(1, 7), "block") | {7: "allow"}


def test_a_long_chain_and_a_hot_target(spark):
    rows = [(i, f"http://p{i}.org/", CANONICAL.format(f'rel="canonical" href="http://p{i + 1}.org/"')) for i in range(80)]
    rows += [(100 + i, f"http://q{i}.org/", CANONICAL.format('rel="canonical" href="http://p80.org/"')) for i in range(300)]
    assert {v[3] for v in judged(spark, rows).values()} == {"allow"}
    rows.append((999, "http://p80.org/", CANONICAL.format('rel="canonical" href="http://x.net/"')))
    assert {v[3] for v in judged(spark, rows).values()} == {"block"}


def test_odd_tables(spark, table):
    pages = table("pages").withColumns({c: F.lit("mine") for c in ("rule", "verdict", "host", "node", "component")})
    twice = pages.union(pages)
    assert urls.verdicts(twice).count() == twice.count()
    assert urls.verdicts(pages.where("false")).count() == 0
