"""Hot keys: one key holding a large share of the rows gives whole, exact results."""

from pyspark.sql import functions as F

from corpusmill.operators import blocks as B, links as L, qa, splits
from corpusmill.sources import export


def test_page_concat_one_huge_document(spark):
    n = 3000
    df = spark.range(n).select(F.lit("big").alias("url"), (F.col("id") * 7 % n).alias("page_no"),
                               (F.col("id") * 7 % n).cast("string").alias("text"))
    small = spark.createDataFrame([("s", 0, "x")], "url string, page_no long, text string")
    got = {r.url: r.text for r in B.concat_page_text(df.unionByName(small), bucket=64).collect()}
    assert got["big"] == "".join(str(i) for i in range(n)) and got["s"] == "x"


def test_lookback_within_one_huge_document(spark):
    n = 2000
    ch = spark.range(n).select(F.lit(1).cast("long").alias("ord"), F.col("id").alias("chunk_no"),
                               F.lit("u").alias("url"), F.col("id").cast("string").alias("data"))
    got = {r.chunk_no: r.context for r in qa.lookback_context(ch, 2, within="ord").collect()}
    assert len(got) == n and got[0] == "0" and got[1] == "01" and got[1999] == "199719981999"


def test_grouped_split_with_dominant_group(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 1000, F.lit("hot"))
                                  .otherwise((F.col("id") % 50).cast("string")).alias("g"))
    out = splits.split_grouped(df, "g", seed=9)
    assert out.count() == 3000
    assert out.groupBy("g").agg(F.countDistinct("split").alias("k")).where("k > 1").count() == 0


def test_hot_destination_and_hot_export_key(spark):
    links = spark.range(5000).select(F.col("id").cast("string").alias("src"), F.lit(0).cast("long").alias("pos"),
                                     F.lit("https://hub/").alias("dst"))
    assert L.distinct_links(links).count() == 5000
    recs = spark.range(5000).select(F.col("id").alias("ord"), F.lit("https://same/x").alias("url"),
                                    F.col("id").cast("string").alias("text"))
    assert [r.text for r in export.export_table(recs).collect()] == ["4999"]
