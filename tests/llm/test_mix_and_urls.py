from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from oracle_compare import connect, differences
from pyspark.sql import functions as F

from eventmarts.llm import host_reputation as H
from eventmarts.llm import poisson_mix as P
from eventmarts.llm.registry import llm_oracles, llm_queries


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_matches_sql(spark, sf, name):
    assert differences(llm_queries()[name](spark, sf), connect(sf), llm_oracles()[name]) == []


def test_shares_follow_the_weights(spark, make_docs):
    rows = [(i, "x" * 10, "en", "big" if i % 10 else "small", 10) for i in range(6000)]
    got = Counter(r.source for r in P.mix(make_docs(rows), {"big": 1.0, "small": 3.0}, 1.5).collect())
    assert abs(got["small"] / sum(got.values()) - 0.75) < 0.03
    assert abs(sum(got.values()) / 9000 - 1) < 0.06


def test_copies_are_the_inverted_poisson(make_docs):
    rows = [(i, "x" * 10, "en", "s", 10) for i in range(4000)]
    copies = {r.doc_id: r.copies for r in P.mix(make_docs(rows), {"s": 1.0}, 2.0).collect()}
    counts = Counter(copies.get(i, 0) for i in range(4000))
    for k in range(6):
        assert abs(counts[k] / 4000 - math.exp(-2) * 2**k / math.factorial(k)) < 0.03


def test_high_rates_and_edges(make_docs):
    few = P.mix(make_docs([(1, "abc", "en", "s", 3), (2, "x" * 3000, "en", "t", 9)]), {"s": 1.0}).collect()
    assert {r.doc_id for r in few} == {1} and abs(len(few) - 1001) < 150
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (5, "a", "en", None, 1), (5, "a", "en", None, 1)]
    twice = [r.copy for r in P.mix(make_docs(rows)).collect() if r.doc_id == 5]
    assert sorted(twice) == sorted([*set(twice), *set(twice)])
    assert P.mix(make_docs([])).count() == 0


def test_the_deal_does_not_depend_on_partitions(make_docs):
    docs = make_docs([(i, "t" * (i % 7 + 1), "en", f"s{i % 3}", 1) for i in range(300)])
    one, many = P.mix(docs.coalesce(1)), P.mix(docs.repartition(7))
    assert Counter(one.collect()) == Counter(many.collect())


def test_rows_of_null_or_shared_ids_are_drawn_each(make_docs):
    rows = [(None, f"text {i:05d}", "en", "big", 10) for i in range(3000)] + [(7, f"text {i:05d}", "en", "small", 10) for i in range(1000)]
    got = P.mix(make_docs(rows), {"big": 1.0, "small": 1.0}).collect()
    shares = Counter(r.source for r in got)
    assert abs(shares["big"] / len(got) - 0.5) < 0.04 and abs(len(got) / 4000 - 1) < 0.06
    assert len({r.copies for r in got if r.source == "small"}) > 2


def test_equal_rows_go_to_many_tasks(spark, make_docs):
    rows = [(None, "the same", "en", "s", 8)] * 2000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mixed = P.mix(make_docs(rows).repartition(16), {"s": 1.0}, 3.0)
        sizes = [r["count"] for r in mixed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) > 1 and max(sizes) < 0.45 * sum(sizes)


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com/en/", "https://a.example.com/EN/",
    "http://example.com", "http://notexample.com/en/", "ftp://x.net/es/1#f", "http://net/fr/", "http://É.Net?q=/fr/", "a://b://c/d", "http://co.uk/x", "http://a.b.co.uk/x",
]


def plain_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in H.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(str(r)), default=None)
    return host, path, best and str(best), best and best.verdict


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate([*URLS, URLS[5]])], "page_id bigint, url string, host string, m string")
    none = spark.createDataFrame([], "url string, good int")
    for r in H.filter_urls(pages, none).collect():
        host, path, rule, verdict = plain_url([*URLS, URLS[5]][r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("allow" if r.good_bound >= H.LEAST_GOOD else "block"))
    assert H.filter_urls(pages.limit(0), none).count() == 0


def test_hosts_are_shrunk_to_their_parents(spark):
    told = [("http://good.one.org/", 1)] * 300 + [("http://bad.one.org/", 0)] * 100 + [("http://new.two.org/", 1)] * 2 + [("http://x.two.org/", 1)] * 200 + [("http://new.two.org/", None)]
    outcomes = spark.createDataFrame(told, "url string, good int")
    pages = outcomes.select(F.monotonically_increasing_id().alias("page_id"), "url").union(spark.createDataFrame([(9**9, "http://unseen.two.org/"), (9**9 + 1, "http://q.three.org/")], "page_id bigint, url string"))
    bound = {r.host: r.good_bound for r in H.filter_urls(pages, outcomes).select("host", "good_bound").distinct().collect()}
    assert bound["bad.one.org"] < 0.3 < H.LEAST_GOOD < bound["good.one.org"]
    assert bound["good.one.org"] > bound["q.three.org"]
    assert bound["new.two.org"] > bound["unseen.two.org"] > bound["bad.one.org"]
