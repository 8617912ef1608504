"""B1-B14 goldens (FIXTURES H1-H5, U1-U11, T1-T4) and block/link properties."""

import pytest

from helpers import SF_SMALL
from corpusmill.functions import text as T
from corpusmill.functions.html_tree import read_blocks
from corpusmill.functions.web import UrlPolicy, absolutize, content_kind, decode_html, is_http_href, url_allowed
from corpusmill.operators import blocks as B, links as L
from corpusmill.plans import catalog

H1 = '<div><h1>T&amp;t</h1><p>a<b>b<br><p>c</p><p>d</p></div><p>e<script>x</script></p>'
HTML = {
    "H1": (H1, ["T&t", "abcd", "c", "d", "e"], "T&t abcd c d e"),
    "H2": ("<p>Sorry, Internet Explorer is not supported.</p><p>ok</p>",
           ["Sorry, Internet Explorer is not supported.", "ok"], "ok"),
    "H3": ("<div>plain</div>", [], ""),
    "H4": ("<p> a\nb </p><p></p>", ["a\nb", ""], "a b "),
    "H5": ("<p>x<!-- no --></p></p><h7>y</h7>", ["x"], "x"),
}


def _pages(spark, html):
    return spark.createDataFrame([("u", html)], "url string, html string")


@pytest.mark.parametrize("case", sorted(HTML))
def test_nested_blocks_and_page_text(spark, case):
    html, blocks, text = HTML[case]
    got = B.extract_blocks(_pages(spark, html), "nested").orderBy("pos").collect()
    assert [r.text for r in got] == blocks
    assert B.page_texts(_pages(spark, html), "nested").first().text == text


def test_leaf_blocks_h1(spark):
    got = B.extract_blocks(_pages(spark, H1), "leaf").orderBy("pos").collect()
    assert [r.text for r in got] == ["T&t", "ab", "c", "d", "e"]
    assert [r.tag for r in got] == ["h1", "p", "p", "p", "p"]


@pytest.mark.parametrize("case", ["H2", "H3", "H4", "H5"])
def test_leaf_page_text_agrees_on_flat_pages(spark, case):
    html, _, text = HTML[case]
    assert B.page_texts(_pages(spark, html), "leaf").first().text == text


def test_page_text_over_block_table(spark):
    blocks = B.drop_blocks(B.extract_blocks(_pages(spark, HTML["H2"][0]), "nested"))
    assert B.page_text(blocks).first().text == "ok"


def test_nested_reader_rules():
    assert read_blocks("<p>a<style>x</style><template><p>t</p></template>b") == [("p", "ab"), ("p", "")]
    assert read_blocks("<p>a <b> </b>\n<i>\t\n</i>c</p>")[0][1] == "a  \n\nc"
    assert read_blocks("<h2>x<![CDATA[y]]></h2>") == [("h2", "xy")]
    assert read_blocks("<p><ruby>K<rp>(</rp><rt>kan</rt><rp>)</rp></ruby>e</p>") == [("p", "Ke")]
    assert read_blocks(None) == []


def test_leaf_and_nested_same_block_count_on_pages(spark):
    pages = catalog._pages(spark, SF_SMALL)
    assert B.extract_blocks(pages, "leaf").count() == B.extract_blocks(pages, "nested").count()


def test_content_kind_t1(spark):
    df = spark.createDataFrame([("application/pdf;x",), ("text/html; charset=utf-8",),
                                ("image/png",), (None,), ("Text/HTML",)], "ct string")
    assert [r.k for r in df.select(content_kind("ct").alias("k")).collect()] == \
        ["pdf", "html", "other", "other", "other"]


def test_decode_html_b2(spark):
    df = spark.createDataFrame([(bytearray(b"ok \xc3\xa9"),), (bytearray(b"\x80bad"),)], "b binary")
    assert [r.t for r in df.select(decode_html("b").alias("t")).collect()] == ["ok é", None]


# U1-U11 with a neutral domain standing in for the reference's.
POLICY = UrlPolicy(deny_substrings=("linkdin.com", "linkedin.com", "github.com", "twitter.com"),
                   deny_patterns=("acme.com/ja", "intercom-attachments-7"),
                   require_pattern="acme")
URLS = {
    "U1": ("#top", False), "U2": ("/x", False), "U3": ("HTTP://acme.com", False),
    "U4": ("https://ACME.com/en", True), "U5": ("https://www.acme.com/JA/x", False),
    "U6": ("https://x.com/?r=acme", True), "U7": ("https://acme.com/?to=github.com", False),
    "U8": ("https://GitHub.com/acme", True), "U9": ("https://acmeXcom/ja", False),
    "U10a": ("https://acme.com", True), "U10b": ("https://acme.com/", True),
    "U11": ("mailto:a@acme.com", False),
}


def test_url_policy_u1_u11(spark):
    rows = [(k, h) for k, (h, _) in URLS.items()]
    df = spark.createDataFrame(rows, "k string, href string")
    got = {r.k: r.ok for r in df.select(
        "k", (is_http_href("href") & url_allowed("href", POLICY)).alias("ok")).collect()}
    assert got == {k: v for k, (_, v) in URLS.items()}


def test_absolutize_modes(spark):
    df = spark.createDataFrame([("https://a.acme.com/p?q#f", "/x")], "src string, href string")
    r = df.select(absolutize("href", "src", "drop").alias("d"),
                  absolutize("href", "src", "concat").alias("c"),
                  absolutize("href", "src", "resolve").alias("r")).first()
    assert (r.d, r.c, r.r) == ("/x", "https://a.acme.com/p?q#f/x", "https://a.acme.com/x")


def test_links_stats_and_distinct(spark):
    html = ('<a href="https://acme.com/a">1</a><a href=\'https://github.com/acme\'>2</a>'
            '<!-- <a href="https://acme.com/hidden"> --><a href=https://acme.com/a>3</a>'
            '<a href="">4</a><a name="x">5</a><a href="/rel">6</a><a href="https://acme.com/&amp;b">7</a>')
    pages = spark.createDataFrame([("https://acme.com/", html)], "url string, html string")
    links = L.extract_links(pages)
    assert [r.href for r in links.orderBy("pos").collect()] == [
        "https://acme.com/a", "https://github.com/acme", "https://acme.com/a", "/rel",
        "https://acme.com/&b"]
    absd = L.absolute_links(links, "drop")
    assert absd.count() == 4
    stats = L.link_stats(L.classify_links(absd, POLICY)).first()
    assert (stats.n_links, stats.n_rejected) == (4, 1)
    dist = L.distinct_links(absd).orderBy("pos").collect()
    assert [(r.dst, r.pos) for r in dist] == [("https://acme.com/a", 0),
                                              ("https://github.com/acme", 1),
                                              ("https://acme.com/&b", 4)]


def test_text_functions_t2_t3_t4(spark):
    df = spark.createDataFrame([("it’s “q” ‘z’", "abcdefghij", r"https://a.b/c?d=http://e:1\f")],
                               "q string, p string, u string")
    r = df.select(T.normalize_quotes("q").alias("q"), T.preview("p", 8).alias("p8"),
                  T.preview("p", 10).alias("p10"), T.file_key("u").alias("k")).first()
    assert r.q == "it's \"q\" ‘z'"
    assert (r.p8, r.p10) == ("abcde...", "abcdefghij")
    assert r.k == r"a.b_c_d=e_1\f"


def test_concat_page_text_t11(spark):
    df = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a\n")], "url string, page_no int, text string")
    assert B.concat_page_text(df, bucket=1).first().text == "a\nb"


def test_leaf_plan_is_native(spark):
    plan = catalog.page_text_leaf(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    scan = catalog.links(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "page_id" not in scan.split("ReadSchema")[-1]   # only url and html are read


@pytest.mark.parametrize("case", sorted(HTML))
def test_block_table_page_text_equals_per_page(spark, case):
    pages = _pages(spark, HTML[case][0])
    per_page = {r.url: r.text for r in B.page_texts(pages, "nested").collect()}
    blocks = B.drop_blocks(B.extract_blocks(pages, "nested"))
    from_blocks = {r.url: r.text for r in B.page_text(blocks).collect()}
    # a page without blocks has no row in a block table
    assert from_blocks == {u: t for u, t in per_page.items() if blocks.count() or t}


@pytest.mark.parametrize("mode", ["leaf", "nested"])
def test_page_texts_keep_columns(spark, mode):
    pages = spark.createDataFrame([("u", 7, "<p>x</p>")], "url string, page_id long, html string")
    r = B.page_texts(pages, mode, keep=("page_id",)).first()
    assert (r.url, r.page_id, r.text) == ("u", 7, "x")


def test_nested_output_leaves_in_bounded_groups():
    import pandas as pd

    from corpusmill.operators import blocks

    pages = pd.DataFrame({"url": ["a", "b", "c"], "html": ["<p>x" * 40, None, "<p>y</p>"]})
    groups = list(blocks._nested_blocks_batches([pages], flush_chars=300))
    whole = list(blocks._nested_blocks_batches([pages]))
    assert len(groups) > 5 and len(whole) == 1
    assert pd.concat(groups, ignore_index=True).equals(whole[0])
    assert list(whole[0]["pos"]) == [*range(40), 0]
    texts = list(blocks._nested_page_text_batches([pages], (), flush_chars=1))
    assert len(texts) == 3
    assert pd.concat(texts).equals(list(blocks._nested_page_text_batches([pages], ()))[0])
