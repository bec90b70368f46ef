import pytest

from casewright.llm import bloom, url_filter
from casewright.llm.queries import ORACLES, QUERIES, REPORTED, RULES, reported_urls
from tests.compare import difference


def test_query(spark, sf, con):
    name = "op6_url_filter"
    got = QUERIES[name](spark, sf).toPandas()
    assert difference(got, con.sql(ORACLES[name]).df()) is None
    assert set(got["verdict"]) == {"block", "allow"} and set(got["rule"].dropna()) == {r.name for r in RULES}


def test_list_is_no_host_pattern(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    extra = [("https://clean.example.com/en/77/?b=2&a=1",), ("http://m.casino-win.example.com/en/77/",), ("http://clean.example.com/en/78",), ("http://clean.example.com/en/77/",),
             ("http://clean.example.com/en/77/print?utm_source=x",), ("http://casino.example.com/",), ("http://clean.example.com/",), (None,), ("no scheme",), ("http://www.pills.example.com:80",)]
    own = spark.createDataFrame([(-1 - i, *u) for i, u in enumerate(extra)], pages.schema)
    got = {r.page_id: r.verdict for r in url_filter.judge(pages.unionByName(own), reported_urls(pages.unionByName(own)), RULES).collect()}
    assert [got[-1 - i] for i in range(len(extra))] == ["block", "block", "allow", "block", "block", "block", "allow", "allow", "allow", "block"]
    assert reported_urls(pages.limit(0)).count() == 0


def plain_host_path(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[cut:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if c.isascii() else c for c in rest[:cut]), tail[:stop]


URLS = ["http://A.Net/x", "http://a.net", "http://net/", "https://b.example.net/en/1", "https://example.net/en", "https://example.com/de/7?q#f", "x://notexample.com/de/",
        "http://sub.org/fr/", "http://org/fr/a", "http://org.com/fr/", "no scheme", None, "", "://", "http://É.Com/a#b?c", "http://h.io/a/?b=2&a=1&utm_source=x", "https://www.h.io:443/a?a=1&b=2#z",
        "http://h.io/a?a=1", "a://b://c/d", "http://line\nbreak.net/p\nq?z"]


def test_parts_and_list(spark):
    pages = spark.createDataFrame([(i, u, "old", i) for i, u in enumerate(URLS)] + [(99, "http://h.io/a?b=2&a=1", "old", 1)] * 30, "page_id long, url string, verdict string, n long")
    listed = spark.createDataFrame([("HTTP://www.H.io/a/?a=1&b=2&ref=q",), (None,), ("",), ("http://org/fr/a",)], "url string")
    got = url_filter.judge(pages, listed, RULES).collect()
    assert len(got) == len(URLS) + 30
    for r in got:
        url = URLS[r.page_id] if r.page_id < 99 else "http://h.io/a?b=2&a=1"
        host, path = plain_host_path(url)
        assert (r.host, r.path) == (host, path)
        fit = [x for x in RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fit, key=lambda x: len(x.name), default=None)
        assert r.rule == (best.name if best else None)
        assert r.verdict == (best.verdict if best else "block" if r.page_id in (15, 16, 99) else "allow"), url
    empty = listed.limit(0)
    assert {r.verdict for r in url_filter.judge(pages, empty, []).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), listed, RULES).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_bloom_has_all_and_little_else(spark, n):
    df = spark.range(n, numPartitions=5).selectExpr("xxhash64(id) AS h").union(spark.range(n // 2).selectExpr("xxhash64(id) AS h"))
    once, twice = bloom.build(df, lambda b: b.column("h").to_numpy().view("uint64"), bloom.bits_for(n), "test")
    known, other = (spark.range(a, b).selectExpr("xxhash64(id) AS h").toPandas()["h"].to_numpy("int64").view("uint64") for a, b in ((0, n), (10**6, 10**6 + 10_000)))
    assert bloom.holds(once, known).all() and bloom.holds(twice, known[:n // 2]).all()
    if n > 1:
        assert bloom.holds(once, other).mean() < 0.02 and bloom.holds(twice, known[n // 2:]).mean() < 0.05
