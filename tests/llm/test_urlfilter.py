"""Url filter: exact membership in shards and levels, rules, odd rows."""

import random

import pytest

from attesta.llm import urlfilter
from attesta.llm.catalog import URL_RULES

BIG = 2**53 + 1


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    stop = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return host, path[:stop]


def plain_verdict(url, listed):
    host, path = plain_parts(url)
    best = None
    for rule in URL_RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            if best is None or len(rule.name) > len(best.name):
                best = rule
    is_listed = host + path in listed
    return host, path, best and best.name, best.action if best else "block" if is_listed else "allow", is_listed


def urls(rng, n):
    hosts = ["Example.net", "a.example.com", "example.com", "x.org", "notexample.com", "b.net", "plain.io", "org"]
    paths = ["/en/", "/de/a", "/fr/x.html", "", "/", "/deep/path"]
    out = [f"https://{rng.choice(hosts)}{rng.choice(paths)}{i % 40}?q={i}#f" for i in range(n)]
    return out + [None, "", "no scheme", "://", "http://", "http://?x", "a://b://c/d", "http://h\n/p", "http://é.org/fr/ü"]


@pytest.mark.parametrize("max_bits", [1 << 26, 64, 1000])
def test_verdicts_equal_plain_rules(spark, max_bits):
    """One shard and many; a list with keys of no page, repeats and a null."""
    rng = random.Random(max_bits)
    rows = [(i, u) for i, u in enumerate(urls(rng, 400))]
    keys = sorted({"".join(plain_parts(u)) for _, u in rows})
    listed = rng.sample(keys, 60) + ["in.no/page", "in.no/page", ""]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").repartition(3)
    bad = spark.createDataFrame([(k,) for k in [*listed, None]], "key string")
    found = urlfilter.judge(pages, bad, URL_RULES, urlfilter.CascadeParams(max_bits=max_bits))
    got = {r.page_id: tuple(r)[1:] for r in found.collect()}
    assert got == {i: plain_verdict(u, set(listed)) for i, u in rows}


@pytest.mark.parametrize("rate", [0.5, 0.01])
def test_membership_is_exact_at_any_rate(spark, rate):
    rng = random.Random(7)
    rows = spark.createDataFrame([(f"k{rng.randrange(3000)}",) for _ in range(4000)] + [(None,)], "key string")
    listed = spark.createDataFrame([(f"k{i}",) for i in range(0, 3000, 7)], "key string")
    found = urlfilter.with_membership(rows, listed, urlfilter.CascadeParams(later_rate=rate)).collect()
    assert len(found) == 4001
    assert all(r.listed == (r.key is not None and int(r.key[1:]) % 7 == 0) for r in found)


def test_levels_have_a_bound(spark):
    rows = spark.createDataFrame([(f"k{i}",) for i in range(2000)], "key string")
    with pytest.raises(RuntimeError, match="later_rate"):
        urlfilter.with_membership(rows, rows.filter("key < 'k5'"), urlfilter.CascadeParams(max_levels=1))


def test_odd_tables(spark):
    schema = "page_id bigint, url string, html string, host string, listed boolean, key int"
    rows = [(BIG, "http://a.net/x", "h", "clash", True, 1), (None, "http://b.io/x", None, None, None, None),
            (4, "http://b.io/x", None, None, None, None), (4, "http://b.io/x", None, None, None, None),
            (5, "http://" + "a" * 50_000 + ".net/" + "p" * 50_000, "", "", False, 0)]
    pages = spark.createDataFrame(rows, schema).coalesce(1)
    bad = spark.createDataFrame([("b.io/x",)], "key string")
    got = sorted(((r.page_id, r.verdict, r.listed) for r in urlfilter.judge(pages, bad, URL_RULES).collect()), key=str)
    assert got == sorted([(BIG, "block", False), (None, "block", True), (4, "block", True), (4, "block", True),
                          (5, "block", False)], key=str)
    none = bad.limit(0)
    assert {r.verdict for r in urlfilter.judge(pages.filter("page_id = 4"), none, URL_RULES).collect()} == {"allow"}
    assert urlfilter.judge(pages.limit(0), bad, URL_RULES).collect() == []
    labels = spark.createDataFrame([(7, 0), (8, 1), (None, 0)], "doc_id bigint, quality int")
    numbered = spark.createDataFrame([(1, "http://h/a/7.html"), (2, "http://h/a/8"), (3, "http://h/7/x"), (4, None)],
                                     "page_id bigint, url string")
    assert [r.key for r in urlfilter.low_quality_keys(numbered, labels).collect()] == ["h/a/7.html"]
