"""URL filters and source mixes against plain loops."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lakelens.llm.mixing import mix, route, source_targets
from lakelens.llm.url_filters import judge_urls, rule_table

RULES = [("net", "/", "block"), ("shop.net", "/ok/", "allow"), ("a.b", "/x", "block"), ("a.b", "/x", "allow"), ("q", "", "block")]
URLS = [
    "http://NET/",
    "https://www.shop.net/ok/1?x=/no/",
    "https://www.shop.net/okay",
    "http://internet/",
    "ftp://c.a.b/xyz/1#f",
    "http://a.b",
    "http://a.b?x",
    "q://q",
    "q://x.q/deep/" + "d/" * 500,
    "http://net",
    "no scheme",
    "",
    None,
    "http://",
    "http:///x",
    "http://..net//",
]


def judged(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), len(h), v == "block", h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


def test_urls(spark):
    rows = [(i, url, "host", "rule") for i, url in enumerate(URLS)] + [(None, URLS[0], "", "")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    found = judge_urls(pages, rule_table(spark, RULES)).collect()
    expected = [(i, *judged(url)) for i, url, *_ in rows]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_urls_without_rules(spark):
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    rules = rule_table(spark, RULES).limit(0)
    assert [tuple(r) for r in judge_urls(pages, rules).collect()] == [(1, "net", "/", None, "allow")]
    partial = spark.createDataFrame([(None, "/", "block"), ("net", None, "block")], "host string, path string, verdict string")
    assert judge_urls(pages, partial).first()["rule"] is None


def test_targets():
    targets = source_targets({"a": 100, "b": 10, "c": 1000, None: 50})
    assert targets[None] == 100 and targets["a"] == 200  # weights 3, 1, 2, 3; both stop at twice their size
    left = Fraction(3, 2) * 1160 - 300
    assert targets["b"] == min(20, left / 3) and targets["c"] == left - targets["b"]
    assert source_targets({}) == {} and source_targets({"a": 0}) == {"a": 0}


def cheapest(capacity, quotas, rounds):
    """Most words that can flow, and the least sum of squares-like cost, by trying every split of tiny capacities."""
    best = (0, 0)
    patterns = list(capacity)

    def go(i, left, flow, cost):
        nonlocal best
        if i == len(patterns):
            best = max(best, (flow, -cost))
            return
        pattern = patterns[i]

        def spread(j, room, rest, used):
            if j == len(pattern):
                size = capacity[pattern]
                full, more = divmod(used, size)
                go(i + 1, rest, flow + used, cost + size * full * (full - 1) // 2 + more * full)
                return
            for amount in range(min(room, rest[pattern[j]]) + 1):
                spread(j + 1, room - amount, rest | {pattern[j]: rest[pattern[j]] - amount}, used + amount)

        spread(0, rounds * capacity[pattern], left, 0)

    go(0, quotas, 0, 0)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_route_is_cheapest(seed):
    rng = random.Random(seed)
    capacity = {p: rng.randint(1, 3) for p in (("a",), ("a", "b"), ("b", "c"), ("c",)) if rng.random() < 0.8} or {("a",): 2}
    quotas = {s: rng.randint(0, 5) for s in "abc"}
    flows = route(capacity, quotas)
    used = {p: sum(f for (q, _), f in flows.items() if q == p) for p in capacity}
    assert all(used[p] <= 2 * capacity[p] for p in capacity)
    assert all(sum(f for (_, s), f in flows.items() if s == q) <= quotas[q] for q in quotas)
    cost = sum(max(0, used[p] - capacity[p]) for p in capacity)
    assert (sum(used.values()), -cost) == cheapest(capacity, quotas, 2)


def test_mix(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        source = None if i % 3 == 0 else f"s{i % 7}"  # the null source holds a third of all rows
        rows.append((i, " ".join(["w"] * rng.randint(0, 60)), source, "x"))
    rows += [(None, None, "s1", ""), (5000, "", "s2", ""), (5001, "\t a\nb ", "s3", ""), (7, "same row", "s1", ""), (7, "same row", "s1", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    found = mix(docs)
    taken = found.collect()
    assert len(taken) == len(rows)
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = source_targets(sizes)
    for source in sizes:
        own = [r for r in taken if r["sources"] == [source]]
        assert sum(r["size"] for r in own) == sizes[source] == own[0]["source_size"]
        assert own[0]["target"] == pytest.approx(float(targets[source]))
        assert abs(sum(r["taken"] for r in own) - targets[source]) <= 30
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in taken)
    again = mix(docs.repartition(7)).select("doc_id", "row", "taken")
    assert again.exceptAll(found.select("doc_id", "row", "taken")).count() == 0


def test_mix_of_overlapping_sources(spark):
    docs = spark.createDataFrame([(i, "a b c d") for i in range(400)], "doc_id long, text string")
    sources = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("x"), F.lit("y"))).when(F.col("doc_id") < 300, F.array(F.lit("x"))).otherwise(F.array())
    found = mix(docs.withColumn("source", sources.cast("array<string>"))).collect()
    assert {r["taken"] for r in found if not r["sources"]} == {0}
    assert sum(r["taken"] for r in found) > 1600 and max(r["copies"] for r in found) == 2
