import random

import pytest

from meterlake.llm import graph, url_rules


def closure(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(7, i) for i in range(40) if i != 7],
        "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(80)],
        "none": [],
    }[kind]
    extra = [(None, 5), (9999, 9999)] + edges[:3]
    got = graph.components(spark.createDataFrame(edges + extra, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == closure([e for e in edges if e[0] != e[1]])


RULES = "action string, rule_host string, rule_path string"


def page(i, url, html=None):
    return (i, url, html, "extra", "r")


def judged(spark, pages, edges=None):
    df = spark.createDataFrame(pages, "page_id long, url string, html string, rule string, host string")
    edges = url_rules.declared_links(df) if edges is None else spark.createDataFrame(edges, "a string, b string")
    rows = url_rules.judge(df, spark.createDataFrame(url_rules.RULES, RULES), edges).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}, len(rows)


def test_longest_rule_of_host_and_parents(spark):
    got, _ = judged(spark, [
        page(1, "http://A.Example.com/en/x?q#f"), page(2, "http://www.example.com/en/"), page(3, "http://x.net/fr/a"), page(4, "http://x.net/de/"),
        page(5, "http://badexample.com/en/"), page(6, "http://example.com"), page(7, None), page(8, "no scheme"), page(9, "://net/es/"),
    ])
    assert got[1] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[2] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[3] == ("x.net", "/fr/a", "net/fr/", "block")
    assert got[4] == ("x.net", "/de/", None, "allow")
    assert got[5][2:] == ("com/", "allow")
    assert got[6] == ("example.com", "", None, "allow")
    assert got[7] == got[8] == ("", "", None, "allow")
    assert got[9] == ("net", "/es/", "net/es/", "block")


def test_block_spreads_to_aliases_and_allow_stands(spark):
    link = '<link href="{}" rel="canonical">'
    pages = [
        page(1, "http://a.org/1", link.format("http://x.net/fr/1")),  # alias of a blocked address
        page(2, "http://a.org/2", '<meta http-equiv="refresh" content="0; url=http://a.org/1">'),  # two steps away
        page(3, "http://b.com/3", link.format("http://x.net/fr/1")),  # has an allow rule of its own
        page(4, "http://c.org/4"), page(4, "http://c.org/4"),
    ]
    got, n = judged(spark, pages[:2] + pages[3:])
    assert n == 4 and [got[i][3] for i in (1, 2, 4)] == ["block", "block", "allow"]
    got, _ = judged(spark, pages)  # the class now holds an allowed address
    assert [got[i][3] for i in (1, 2, 3)] == ["allow", "allow", "allow"]
    got, _ = judged(spark, pages[:1], [("http://a.org/1", None)])
    assert got[1][3] == "allow"


def test_empty_table(spark):
    assert judged(spark, [])[1] == 0


LINKS = [
    "x", "../x", "./x?q=../1", "/", "/a/../b/./c", "../../../x", "a/b/..", "a/.", "..", "?q=1", "//h.net/es/y", "//h.net", "https://o.net/p/../q",
    "/a//b", "x/y#z/../w", "a;b/../c",
]


def test_links_are_resolved_like_a_browser(spark):
    from urllib.parse import urljoin

    from pyspark.sql import functions as F

    bases = ["http://a.net/p/q/r.html?x=1#f", "https://a.net/", "http://a.net/dir/", "http://a.net/one"]
    df = spark.createDataFrame([(b, x) for b in bases for x in LINKS], "base string, link string")
    got = df.select("base", "link", url_rules.resolved(F.col("link"), F.col("base")).alias("r")).collect()
    for r in got:
        assert r["r"] == (r["link"] if "://" in r["link"] else urljoin(r["base"], r["link"])), (r["base"], r["link"])
    none = spark.createDataFrame([("mailto:a@b.c", "http://a.net/"), ("", "http://a.net/"), ("#top", "http://a.net/"), ("x", None), ("x", "no base"), (None, "http://a.net/")], "link string, base string")
    assert [r[0] for r in none.select(url_rules.resolved(F.col("link"), F.col("base"))).collect()] == [None] * 6


def test_redirect_table_against_sql(spark, tmp_path):
    """Relative and scheme-relative links, a base tag, chains and an explicit allow, in Spark and in SQL."""
    import duckdb

    from meterlake.llm import entries

    canonical = '<head><link rel="canonical" href="{}"></head>'
    refresh = "<META content='0;url={}' HTTP-EQUIV=refresh>"
    rows = [
        (1, "http://a.net/es/x", None), (2, "http://a.org/1", canonical.format("//a.net/es/x")), (3, "http://a.net/de/2", canonical.format("../es/x")),
        (4, "http://b.net/p/q", canonical.format("/fr/z")), (5, "http://c.org/5", refresh.format("http://a.org/1")), (6, "http://d.org/6", refresh.format("/7")),
        (7, "http://d.org/7", refresh.format("http://c.org/5")), (8, "http://e.com/8", canonical.format("//f.net/es/")), (9, "http://g.org/9", canonical.format("http://e.com/8")),
        (10, "http://h.org/a?x=1&y=2", None), (11, "http://h.org/b", canonical.format("/a?x=1&amp;y=2")), (12, "http://i.org/c", canonical.format("http://h.org/b")),
        (13, "http://j.org/d", "<base href='http://k.net/fr/'>" + canonical.format("e")), (14, None, canonical.format("//a.net/es/x")), (15, "odd", canonical.format("//a.net/es/x")),
        (16, "http://l.org/f", canonical.format("#here")), (17, "http://l.org/g", canonical.format("mailto:x")), (7, "http://d.org/7", None),
    ]
    extra = "page_id long, url string, html string"
    spark.createDataFrame(rows, extra).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(tuple, entries.op2_url_verdicts(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({entries.SQL_URLS})").fetchall(), key=repr)
    assert got == want
    verdict = {r[0]: r[4] for r in got}
    assert [i for i in sorted(verdict) if verdict[i] == "block"] == [1, 2, 3, 4, 5, 6, 7, 13]
