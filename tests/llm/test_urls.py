"""URL rules: against a plain loop over all rules, odd URLs, and SQL."""

from __future__ import annotations

import random
import time

import pytest
from conftest_llm import CLASHING

from entidex.llm import queries, urls

RULES = queries.URL_RULES
RULE_SCHEMA = "host string, path string, verdict string"
ODD = [
    None, "", "no scheme example.com/en/", "http://", "http:///en/x", "HTTP://WWW.EXAMPLE.COM/en/1", "https://example.com/EN/1", "https://example.com/en/",
    "https://example.com/en", "https://example.com", "https://example.com?x=/en/", "https://example.com#/en/", "https://notexample.com/en/1", "https://a.b.www.example.com/en/1?q#f",
    "https://example.com./en/1", "https://.example.com/en/1", "https://example.com:80/en/1", "https://com/", "https://net/fr/", "https://x.net/es", "https://x.net/es/1\n2",
    "a://b://example.com/en/", "https://ÜBER.example.com/en/ü", "https://example.com//en/", "https://user@www.example.com/en/",
]


def plain(url, rules, default=urls.DEFAULT):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if None not in (h, p, v) and (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, _, verdict, rule = max(fits, default=(0, 0, default, None))
    return host, path, rule, verdict


def judged(spark, given, rules, **more):
    frame = spark.createDataFrame(list(enumerate(given)), "page_id int, url string")
    rows = urls.judge(frame, spark.createDataFrame(rules, RULE_SCHEMA), **more).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r["page_id"])]


def test_odd_urls(spark):
    assert judged(spark, ODD, RULES) == [plain(u, RULES) for u in ODD]


def test_random_rules(spark):
    """Rules that end anywhere in a path, also within a name; several fit at once."""
    rng = random.Random(5)
    host = lambda n: ".".join(rng.choice(["a", "bb", "c", ""]) for _ in range(rng.randint(1, n)))
    path = lambda n: "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, n)))
    rules = [(host(3), path(4), rng.choice(["allow", "block"])) for _ in range(150)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values()) + [("", "", "block")]
    given = [f"s://{host(5)}{path(8)}" for _ in range(800)]
    assert judged(spark, given, rules) == [plain(u, rules) for u in given]


@pytest.mark.parametrize("digits", [1, 64])
def test_digests_confirm(spark, monkeypatch, digits):
    """With short prefixes many expressions share one; only whole digests count."""
    monkeypatch.setattr(urls, "PREFIX", digits)
    assert judged(spark, ODD, RULES) == [plain(u, RULES) for u in ODD]


def test_rules_with_nulls_repeats_and_conflicts(spark):
    rules = [("a.b", "/", "allow"), ("a.b", "/", "block"), ("a.b", "/", "block"), ("B", "/x", "allow"), (None, "/", "block"), ("b", None, "block"), ("b", "/", None), ("b/x", "/", "block")]
    given = ["s://a.b/", "s://c.b/xy", "s://c.b/y"]
    assert judged(spark, given, rules, default="ask") == [("a.b", "/", "a.b/", "block"), ("c.b", "/xy", "b/x", "allow"), ("c.b", "/y", None, "ask")]


def test_repeats_nulls_and_clashing_names(spark):
    rows = [(1, "s://x.com/en/"), (1, "s://x.com/en/"), (1, "s://y.net/es/"), (None, "s://y.net/es/"), (None, None)]
    frame = spark.createDataFrame(rows, "page_id int, url string")
    for name in (*CLASHING, "host", "path", "rule", "verdict", "row", "digest", "prefix", "best", "a.b"):
        frame = frame.withColumn(name, frame.page_id)
    found = urls.judge(frame, spark.createDataFrame(RULES, RULE_SCHEMA))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    got = sorted((r["page_id"] is None, r["rule"] or "", r["verdict"]) for r in found.collect())
    assert got == [(False, "com/", "allow"), (False, "com/", "allow"), (False, "net/es/", "block"), (True, "", "allow"), (True, "net/es/", "block")]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id int, url string")
    rules = spark.createDataFrame(RULES, RULE_SCHEMA)
    assert urls.judge(none, rules).count() == 0
    one = spark.createDataFrame([(1, "s://x.com/")], "page_id int, url string")
    assert [tuple(r) for r in urls.judge(one, rules.filter("false")).collect()] == [(1, "x.com", "/", None, "allow")]


def test_very_long_urls_take_linear_time(spark):
    long = ["s://" + "a." * 500_000 + "com/" + "x/" * 500_000, "s://" + "." * 1_000_000, "s://com/" + "/" * 1_000_000, "://" * 300_000, "s://com/" + "?" * 1_000_000]
    start = time.perf_counter()
    assert judged(spark, long, RULES) == [plain(u, RULES) for u in long]
    assert time.perf_counter() - start < 30


def test_expressions_are_few(spark):
    """Only lengths that rules have are cut, whatever the URL."""
    frame = spark.createDataFrame([(0, "a." * 1000 + "example.com", "/" * 1000)], "row bigint, host string, path string")
    assert urls.expressions(frame, {3: [1, 4], 11: [4], 14: [4]}).count() == 3
