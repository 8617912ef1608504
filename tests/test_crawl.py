"""Fetch lookup, visited anti-join, crawl fixed point."""

import pandas as pd
from pyspark.sql import functions as F

from helpers import SF_SMALL
from corpusmill.functions.web import UrlPolicy
from corpusmill.operators import crawl as C
from corpusmill.plans import catalog, workflows
from corpusmill.sources import records as R

POLICY = UrlPolicy(require_pattern="acme")


def _site(spark, links, extra=()):
    rows = [(u, "".join(f'<a href="{d}">x</a>' for d in ds) + "<p>" + u + "</p>")
            for u, ds in links.items()] + list(extra)
    return spark.createDataFrame(rows, "url string, html string")


def test_crawl_cycle_depth_and_missing(spark):
    pages = _site(spark, {"https://acme/a": ["https://acme/b", "https://acme/c"],
                          "https://acme/b": ["https://acme/a", "https://acme/d"],
                          "https://acme/c": ["https://other/x", "https://acme/c"],
                          "https://acme/z": ["https://acme/a"]})
    got = {r.url: r.depth for r in C.crawl(C.seed_urls(spark, ["https://acme/a"]), pages,
                                           POLICY).collect()}
    assert got == {"https://acme/a": 0, "https://acme/b": 1, "https://acme/c": 1,
                   "https://acme/d": 2}                       # d is missing but visited
    lim = C.crawl(C.seed_urls(spark, ["https://acme/a"]), pages, POLICY, max_depth=1)
    assert lim.count() == 3


def test_crawl_independent_of_partitions(spark):
    pages = catalog.linked_pages(spark, SF_SMALL)
    seed = catalog._seed(pages)
    a = sorted(C.crawl(seed, pages, catalog.TEST_POLICY).collect())
    b = sorted(C.crawl(seed, pages.repartition(5), catalog.TEST_POLICY).collect())
    c = sorted(C.crawl(seed, pages, catalog.TEST_POLICY, num_partitions=3).collect())
    assert a == b == c and len(a) > 10


def test_unvisited_c1(spark):
    fr = spark.createDataFrame([("a",), ("a",), ("b",), ("a/",), ("A",)], "url string")
    vis = spark.createDataFrame([("a",)], "url string")
    assert sorted(r.url for r in C.unvisited(fr, vis).collect()) == ["A", "a/", "b"]


def test_fetch_lookup_and_plugin(spark):
    pages = spark.createDataFrame([("u1", "<p>x</p>")], "url string, html string")
    fr = spark.createDataFrame([("u1",), ("u2",)], "url string")
    got = {r.url: r.found for r in C.fetch_pages(fr, pages).collect()}
    assert got == {"u1": True, "u2": False}

    def fetch(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"url": pdf["url"], "content_type": "text/html",
                             "body": [f"<p>{u}</p>".encode() for u in pdf["url"]],
                             "status": "ok"})

    out = C.fetch_pages_with(fr, fetch, partitions=2).collect()
    assert sorted(r.url for r in out) == ["u1", "u2"] and out[0].body.startswith(b"<p>")


def test_crawl_records_kinds(spark):
    pages = spark.createDataFrame([("u1", "<p>a</p>", "text/html"), ("u2", "%PDF", "application/pdf"),
                                   ("u3", "x", "image/png")], "url string, html string, ct string")
    visited = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u4",)], "url string")
    pdf_texts = spark.createDataFrame([("u2", 2, "b"), ("u2", 1, "a")],
                                      "url string, page_no int, text string")
    got = {r.url: (r.kind, r.text) for r in
           C.crawl_records(visited, pages, content_type_col="ct", pdf_texts=pdf_texts).collect()}
    assert got == {"u1": ("html", "a"), "u2": ("pdf", "ab"), "u3": ("other", "")}
    assert {r.status for r in C.crawl_records(visited, pages, content_type_col="ct").collect()} == {"ok"}


def test_crawl_and_save_g1(spark, tmp_dir):
    pages = _site(spark, {"https://acme/a": ["https://acme/b"], "https://acme/b": []})
    out = tmp_dir + "/records"
    workflows.crawl_and_save(C.seed_urls(spark, ["https://acme/a"]), pages, POLICY, out)
    got = {r.url: r.text for r in R.read_records(spark, out).collect()}
    assert got == {"https://acme/a": "https://acme/a", "https://acme/b": "https://acme/b"}


def test_crawl_edges_partitioned_once(spark):
    pages = catalog.linked_pages(spark, SF_SMALL)
    edges = C.link_graph(pages, catalog.TEST_POLICY)
    assert edges.where(F.col("src").isNull()).count() == 0


def test_crawl_records_binary_bodies_b2(spark):
    pages = spark.createDataFrame([("u1", bytearray(b"<p>caf\xc3\xa9</p>"), "text/html"),
                                   ("u2", bytearray(b"<p>\x80</p>"), "text/html"),
                                   ("u3", bytearray(b"%PDF\xff"), "application/pdf")],
                                  "url string, body binary, ct string")
    visited = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    got = {r.url: (r.kind, r.text, r.status) for r in
           C.crawl_records(visited, pages, html_col="body", content_type_col="ct").collect()}
    assert got == {"u1": ("html", "café", "ok"), "u2": ("html", "", "decode_error"),
                   "u3": ("pdf", "", "ok")}


def test_one_record_for_a_url_stored_twice(spark):
    pages = spark.createDataFrame([("u1", "<p>old</p>", 1), ("u1", "<p>new</p>", 2), ("u2", "<p>x</p>", None),
                                   ("u2", "<p>x</p>", None)], "url string, html string, ver int")
    visited = spark.createDataFrame([("u1",), ("u2",)], "url string")
    got = [tuple(r) for r in C.crawl_records(visited, pages, version_col="ver").select("url", "text").collect()]
    assert sorted(got) == [("u1", "new"), ("u2", "x")]
    plain = {tuple(r) for _ in range(2) for r in
             C.crawl_records(visited, pages.repartition(3)).select("url", "text").collect()}
    assert len(plain) == 2


def test_links_of_responses_without_a_content_type(spark):
    site = {"https://acme/a": '<a href="https://acme/b">b</a>', "https://acme/b": '<a href="https://acme/c">c</a>',
            "https://acme/c": "<p>C</p>"}

    def fetch(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"url": pdf["url"], "content_type": [None if u.endswith("b") else "text/html" for u in pdf["url"]],
                             "body": [site[u].encode() for u in pdf["url"]], "status": "200"})

    visited, _ = C.crawl_fetching(C.seed_urls(spark, ["https://acme/a"]), fetch, POLICY)
    assert {r.url for r in visited.collect()} == set(site)


def test_crawl_fetching_live(spark):
    site = {"https://acme/a": '<a href="/b">b</a><a href="https://acme/c">c</a><p>A</p>',
            "https://acme/b": '<a href="https://acme/a">a</a><p>B</p>',
            "https://acme/c": '<a href="https://other/x">x</a>'}

    def fetch(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [u in site for u in pdf["url"]]
        return pd.DataFrame({"url": pdf["url"],
                             "content_type": ["text/html" if f else None for f in found],
                             "body": [site[u].encode() if u in site else None for u in pdf["url"]],
                             "status": ["200" if f else "404" for f in found]})

    visited, fetched = C.crawl_fetching(C.seed_urls(spark, ["https://acme/a"]), fetch, POLICY)
    assert {r.url: r.depth for r in visited.collect()} == {
        "https://acme/a": 0, "https://acme/b": 1, "https://acme/c": 1}
    assert fetched.count() == 3
    recs = {r.url: r.text for r in C.crawl_records(visited, fetched, html_col="body",
                                                    content_type_col="content_type").collect()}
    assert recs == {"https://acme/a": "A", "https://acme/b": "B", "https://acme/c": ""}
    lim, _ = C.crawl_fetching(C.seed_urls(spark, ["https://acme/a"]), fetch, POLICY, max_depth=0)
    assert lim.count() == 1
