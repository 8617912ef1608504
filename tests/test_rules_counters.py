"""B10 rule tables, E1 over gaps and block borders, failed fetches, G5 counters."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.functions.web import UrlPolicy, host, host_suffixes
from corpusmill.operators import crawl as C, links as L, qa
from corpusmill.streaming import records as S
from corpusmill.streaming.counters import BatchCounters


def test_host_and_suffixes(spark):
    urls = ["https://A.b.Example.com:80/x?y", "http://u:p@h.org#f", "ftp://x.y./z", "/rel", "mailto:a@b.c", None, "https:///p"]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(host("u").alias("h")).collect()
    assert [r.h for r in got] == ["a.b.example.com", "h.org", "x.y", None, None, None, None]
    row = spark.createDataFrame([("a.b.c",)], "h string").select(host_suffixes("h").alias("s")).first()
    assert row.s == ["a.b.c", "b.c", "c"]


def test_most_specific_rule_decides(spark):
    rules = spark.createDataFrame([("spam.com", False), ("good.spam.com", True), ("GOOD.spam.com", True), ("org", False),
                                   ("twice.net", True), ("twice.net", False), (None, False)], "host string, allow boolean")
    dst = {"https://spam.com/": False, "https://x.spam.com/": False, "https://a.good.spam.com/": True, "https://notspam.com/": True,
           "https://a.org": False, "https://twice.net/": False, "relative": True, "https://free.net": True}
    links = spark.createDataFrame([("s", i, u, 9) for i, u in enumerate(dst)], "src string, pos int, dst string, host int")
    out = L.classify_by_hosts(links, rules)
    assert out.columns == ["src", "pos", "dst", "host", "allowed"]
    assert {r.dst: r.allowed for r in out.collect()} == dst
    strict = L.classify_by_hosts(links, rules, default=False)
    assert {r.dst for r in strict.where("allowed").collect()} == {"https://a.good.spam.com/"}
    assert L.classify_by_hosts(links, rules.limit(0)).where("not allowed").count() == 0


def test_plan_size_does_not_grow_with_rules(spark):
    links = spark.createDataFrame([("s", 0, "https://h7.example/")], "src string, pos int, dst string")

    def plan(n):
        rules = spark.range(n).select(F.concat(F.lit("h"), "id", F.lit(".example")).alias("host"), F.lit(False).alias("allow"))
        out = L.classify_by_hosts(links, rules)
        assert out.first().allowed is False
        return len(out._jdf.queryExecution().optimizedPlan().toString())

    assert abs(plan(10) - plan(100_000)) < 20


@pytest.mark.parametrize("block_rows", [1, 2, 3, 1000])
@pytest.mark.parametrize("k", [1, 2, 5])
def test_lookback_over_gaps_and_blocks(spark, block_rows, k):
    rows = [(d, n * (d + 2), chr(97 + d) + str(n)) for d in range(4) for n in range(6)] + [(9, 0, None)]
    chunks = spark.createDataFrame(rows, "ord long, chunk_no long, data string").repartition(3)
    want = {}
    for i, (d, n, _) in enumerate(rows):
        near = rows[max(0, i - k):i + 1]
        want[d, n] = ("".join(x[2] or "" for x in near), "".join(x[2] or "" for x in near if x[0] == d))
    got = qa.lookback_context(chunks, k, block_rows=block_rows).collect()
    assert {(r.ord, r.chunk_no): r.context for r in got} == {p: w[0] for p, w in want.items()}
    got = qa.lookback_context(chunks, k, within="ord", block_rows=block_rows).collect()
    assert {(r.ord, r.chunk_no): r.context for r in got} == {p: w[1] for p, w in want.items()} and len(got) == len(rows)


def test_lookback_golden_gap(spark):
    chunks = spark.createDataFrame([(1, 0, "a"), (1, 2, "b"), (1, 5, "c")], "ord long, chunk_no long, data string")
    got = qa.lookback_context(chunks, 1, within="ord").orderBy("chunk_no").collect()
    assert [r.context for r in got] == ["a", "ab", "bc"]


def test_failed_fetches_are_rows(spark):
    site = {"https://s/0": ["https://s/1", "https://s/bad", "https://s/2"], "https://s/1": [], "https://s/2": ["https://s/3"], "https://s/3": []}

    def fetch(pdf):
        if any(u.endswith("bad") for u in pdf["url"]):
            raise TimeoutError("slow")
        bodies = ["".join(f'<a href="{x}">x</a>' for x in site[u]).encode() for u in pdf["url"]]
        return pd.DataFrame({"url": pdf["url"], "content_type": "text/html", "body": bodies, "status": "ok"})

    seeds = spark.createDataFrame([("https://s/0",)], "url string")
    visited, fetched = C.crawl_fetching(seeds, fetch, UrlPolicy(), fetch_partitions=1, num_partitions=2, on_error="row")
    assert {r.url for r in visited.collect()} == {*site, "https://s/bad"}
    status = {r.url: r.status for r in fetched.collect()}
    assert status.pop("https://s/bad") == "failed: TimeoutError('slow')" and set(status.values()) == {"ok"} and set(status) == set(site)
    with pytest.raises(Exception, match="slow"):
        C.fetch_pages_with(spark.createDataFrame([("https://s/bad",)], "url string"), fetch).collect()


def test_round_counters(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    rounds = []
    C.crawl(spark.createDataFrame([("a",), ("a",)], "url string"), edges, UrlPolicy(), edges=edges, num_partitions=2,
            on_round=lambda depth, n: rounds.append((depth, n["candidates"], n["new"])))
    assert rounds == [(0, 2, 1), (1, 2, 2), (2, 3, 1), (3, 0, 0)]


def test_batch_counters(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, d) for d in ("src", "sink", "ck"))
    rows = spark.createDataFrame([("u1", "t", 1), ("u1", None, 2), ("u2", None, 3)], "url string, text string, ord long")
    with BatchCounters(spark) as counters:
        for part in (rows, rows.limit(1)):
            part.write.mode("append").json(src)
            counters.finish(S.first_records(spark, src, sink, ck))
    got = {(r.batch, r.counter): r.value for r in counters.table().collect()}
    assert got == {(0, "read"): 3, (0, "without_text"): 2, (1, "read"): 1, (1, "without_text"): 0}
    assert counters.table().select("query").distinct().count() == 1
