"""Url verdicts and Bloom cascades against plain lookups."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.support import CLASHING
from tests.support import SMALL
from textpulse.llm.url_cascade import (
    LISTED_DOMAINS,
    RULES,
    BloomFilter,
    cascade_slices,
    flag_keys,
    judge_pages,
    judge_urls,
)


def brute(url, rules, domains):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.DOTALL)
    host, path = found.groups() if found else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)

    def inside(domain):
        return host == domain or host.endswith("." + domain)

    fits = [r for r in rules if inside(r[0]) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    if best:
        return host, path, best[0] + best[1], best[2]
    return host, path, None, "block" if any(map(inside, domains)) else "allow"


GIVEN = [(r.host, r.path, r.verdict) for r in RULES]

URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "https://a.com/x", "ftp://xcom/",
    "http://example.com/en/a", "http://example.com/en", "http://EXAMPLE.com/en/?q", "x://www.example.com/en/",
    "http://m.www.example.com/en/1", "http://wwwexample.com/en/", "http://a.net/es/", "http://net/fr/x#y",
    "http://a.net/ES/", "http://a.net?/es/", "http://a.net#/es/", "http://a.org/en/", "http://b.spam-farm.example.org/x",
    "http://spam-farm.example.com/", "http://xspam-farm.example.org/", "http://É.com/é", "a://b://com/",
    "http://free-bets.example.net/es/", "http://..com/", "http://a.com./", "http://a.com:80/en/",
    "http://" + "a." * 20000 + "com/" + "x" * 100000, "http://\n.com/\n/", "HTTP://www.Example.COM/en/😀",
]


def test_verdicts_of_awkward_urls(spark):
    rows = [(i, url) for i, url in enumerate(URLS)] + [(3, URLS[6]), (3, URLS[6]), (None, URLS[8])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    pages = pages.withColumns({n: F.lit(n) for n in (*CLASHING, "host", "path", "rule", "key")})
    found = judge_pages(pages).collect()
    expected = [(i, *brute(url, GIVEN, LISTED_DOMAINS)) for i, url in rows]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_given_pages_and_no_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = pages.select("page_id", "url").collect()
    found = sorted(tuple(r) for r in judge_pages(pages).collect())
    assert found == sorted((r.page_id, *brute(r.url, GIVEN, LISTED_DOMAINS)) for r in rows)
    assert judge_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize("most_bytes", [2**20, 40])
def test_many_rules_of_many_shapes(spark, most_bytes):
    rng = random.Random(7)

    def host(most):
        return ".".join(rng.choice("abc") for _ in range(rng.randint(1, most)))

    def path():
        return "".join(rng.choice("/ab") for _ in range(rng.randint(0, 4)))

    rules = {(host(4), f"/{path()}"): rng.choice(["allow", "block"]) for _ in range(150)}
    rules = [(*key, verdict) for key, verdict in rules.items()] + [("a", "/", "allow"), ("a", "/", "block")]
    domains = [host(3) for _ in range(10)]
    rows = [(i, f"http://{host(6)}/{path()}{path()}") for i in range(500)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    listed = spark.createDataFrame([(d,) for d in domains], "host string")
    found = judge_urls(pages, given, listed, most_bytes=most_bytes).collect()
    expected = {i: brute(url, rules, domains) for i, url in rows}
    assert {r.page_id: tuple(r)[1:] for r in found} == expected


@pytest.mark.parametrize("most_bytes", [2**20, 700])
def test_membership_is_exact_over_the_universe(spark, most_bytes):
    universe = spark.range(20000).select(F.concat(F.lit("key"), F.col("id") % 15000).alias("key"))
    listed = spark.range(900).select(F.concat(F.lit("key"), F.col("id") * 17).alias("key"))
    cascades = list(cascade_slices(listed.union(listed), universe, most_bytes))
    assert (len(cascades) > 1) == (most_bytes < 2**20)
    assert all(c.bytes < 2 * most_bytes for c in cascades)
    assert max(len(c.filters) for c in cascades) > 2
    rows = universe.distinct().select(F.array("key").alias("keys"))
    found = flag_keys(rows, "keys", "flag", iter(cascades)).collect()
    expected = {f"key{17 * i}" for i in range(900) if 17 * i < 15000}
    assert {r["keys"][0] for r in found if r["flag"][0]} == expected


def test_filters_let_as_many_pass_as_planned():
    rng = np.random.default_rng(0)
    keys = rng.integers(-(2**63), 2**63 - 1, size=(40000, 2))
    plan = BloomFilter.planned(3, 10000, 2.0**-6)
    words = np.zeros(plan.size // 64 + 1, np.uint64)
    places = plan.places(keys[:10000, 0], keys[:10000, 1]).ravel()
    np.bitwise_or.at(words, (places >> np.uint64(6)).astype(int), np.uint64(1) << (places & np.uint64(63)))
    made = BloomFilter(plan.level, plan.size, plan.probes, words)
    assert made.passed(keys[:10000, 0], keys[:10000, 1]).all()
    assert 0.01 < made.passed(keys[10000:, 0], keys[10000:, 1]).mean() < 0.025
