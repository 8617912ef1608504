"""Cases that the first round lost or altered."""

from pyspark.sql import functions as F

from corpusmill.functions import html as H
from corpusmill.operators import splits
from corpusmill.sources import records as R


def _leaf(spark, html):
    df = spark.createDataFrame([(html,)], "h string").select(H.marked_text("h").alias("m"))
    return [(b["tag"], b["raw"]) for b in df.select(H.leaf_blocks(F.col("m")).alias("b")).first()["b"]]


def _hrefs(spark, html):
    return spark.createDataFrame([(html,)], "h string").select(H.hrefs("h").alias("x")).first()["x"]


def test_control_characters_stay_text(spark):
    assert _leaf(spark, "<p>keep \x02 this\x01 and \x03\x04a</p><h2>x</h2>") == [("p", "keep \x02 this\x01 and \x03\x04a"), ("h2", "x")]


def test_references_decode_once(spark):
    html = "<p>caf&eacute; &#8217;&#x41; &amp;lt; &amp;eacute; &nosuch; &#0; R&D &NotEqualTilde;</p>"
    assert _leaf(spark, html) == [("p", "café ’A &lt; &eacute; &nosuch; � R&D ≂̸")]
    assert _leaf(spark, "<p>&amp;amp; &lt;</p>") == [("p", "&amp; <")]


def test_quoted_attributes_and_apostrophes(spark):
    assert _leaf(spark, "<p title=\"a>b\">t</p><p class=x id='>'>u <i title=don't>v</i> it's</p>") == [("p", "t"), ("p", "u v it's")]


def test_href_is_the_attribute_of_that_name(spark):
    assert _hrefs(spark, '<a data-href="https://x/decoy" href="https://x/real">') == ["https://x/real"]
    assert _hrefs(spark, '<a title="a>b" href=/c>') == ["/c"]
    assert _hrefs(spark, '<template><a href="/t?a=1&#38;b=2">x</a></template><abbr href=/no>') == ["/t?a=1&b=2"]


def test_batches_with_ties_and_with_many_boundaries(spark):
    df = spark.createDataFrame([(1, i) for i in range(6)] + [(2, 6), (2, 7)], "k int, i int")
    got = splits.assign_batches(df, ["k"], 4).groupBy("batch").count().collect()
    assert sorted(r["count"] for r in got) == [2, 2, 2, 2]
    many = splits.assign_batches(spark.range(3000), ["id"], 1000).groupBy("batch").count().collect()
    assert len(many) == 1000 and {r["count"] for r in many} == {3}


def test_empty_splits_have_folders(spark, tmp_dir):
    rows = spark.createDataFrame([([("user", "q")], "train")], "messages array<struct<role:string,content:string>>, split string")
    R.write_splits(rows, tmp_dir + "/out")
    for split, n in (("train", 1), ("test", 0), ("valid", 0)):
        assert spark.read.schema(rows.drop("split").schema).json(f"{tmp_dir}/out/split={split}").count() == n
