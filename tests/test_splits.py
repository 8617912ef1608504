"""Batches and exact splits (FIXTURES T6, T7) and their properties."""

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from corpusmill.operators import splits
from corpusmill.operators.rowindex import rows_at_ranks, with_row_index


@pytest.mark.parametrize("n,k,sizes", [(5, 4, [2, 2, 1]), (5, 3, [2, 2, 1]),
                                       (10, 4, [3, 3, 3, 1]), (9, 6, [2, 2, 2, 2, 1])])
def test_batches_t6(spark, n, k, sizes):
    df = spark.range(n).withColumnRenamed("id", "u")
    got = splits.assign_batches(df, ["u"], k).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in got] == sizes
    first = splits.assign_batches(df, ["u"], k).orderBy("u").collect()
    assert [r.batch for r in first] == sorted(r.batch for r in first)   # contiguous


def test_batches_empty(spark):
    df = spark.range(0).withColumnRenamed("id", "u")
    assert splits.assign_batches(df, ["u"], 3).count() == 0


@pytest.mark.parametrize("n,sizes", [(6, (4, 1, 1)), (7, (5, 1, 1)), (10, (8, 1, 1)),
                                     (100, (80, 13, 7)), (1000, (800, 133, 67))])
def test_split_sizes_t7(spark, n, sizes):
    assert splits.split_sizes(n) == sizes
    df = spark.range(n).withColumnRenamed("id", "k")
    got = {r.split: r["count"] for r in splits.split_three_way(df, "k", seed=7)
           .groupBy("split").count().collect()}
    assert (got.get("train", 0), got.get("test", 0), got.get("valid", 0)) == sizes


def test_split_repeatable_and_partition_independent(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = {r.k: r.split for r in splits.split_three_way(df, "k", seed=3).collect()}
    b = {r.k: r.split for r in splits.split_three_way(df.repartition(7), "k", seed=3).collect()}
    c = {r.k: r.split for r in splits.split_three_way(df, "k", seed=4).collect()}
    assert a == b and a != c and len(a) == 500


def test_split_exact_two_way(spark):
    df = spark.range(11).withColumnRenamed("id", "k")
    got = {r.split: r["count"] for r in splits.split_exact(df, "k").groupBy("split").count().collect()}
    assert got == {"train": 8, "test": 3}


def test_grouped_split_never_straddles(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = splits.split_grouped(docs.select("doc_id", "source"), "source", seed=1)
    per_group = out.groupBy("source").agg(F.countDistinct("split").alias("n"))
    assert per_group.where("n > 1").count() == 0
    assert out.count() == docs.count()


def test_row_index_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(5)
    idx = with_row_index(df, ["v"], "i", total_name="n").collect()
    assert sorted((r.v, r.i) for r in idx) == [(v, v) for v in range(1000)]
    assert {r.n for r in idx} == {1000}
    assert rows_at_ranks(df, ["v"], [0, 999, 1000]) == [(0,), (999,), None]


def test_hash_split_fractions_and_repeatable(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    got = {r.s: r["count"] for r in df.select(splits.hash_split(F.col("k"), 1).alias("s"))
           .groupBy("s").count().collect()}
    assert abs(got["train"] / 20000 - 0.8) < 0.02 and abs(got["valid"] / 20000 - 0.0667) < 0.01
    a = df.select("k", splits.hash_split(F.col("k"), 1).alias("s")).orderBy("k").collect()
    b = df.repartition(3).select("k", splits.hash_split(F.col("k"), 1).alias("s")).orderBy("k").collect()
    assert a == b


@pytest.mark.parametrize("digits,few", [(1, 2), (2, 5), (3, 10_000)])
def test_hash_ranks_equal_sorting(spark, digits, few):
    from corpusmill.operators.rowindex import rows_at_hash_ranks

    df = spark.range(700).select(F.md5(F.col("id").cast("string")).alias("h"), F.col("id").cast("string").alias("k"))
    want = sorted((r.h, r.k) for r in df.collect())
    ranks = [0, 1, 349, 350, 698, 699, 700, 5000]
    got = rows_at_hash_ranks(df, "h", "k", ranks, digits, few)
    assert got == [want[r] if r < 700 else None for r in ranks]
    assert rows_at_hash_ranks(df.limit(0), "h", "k", lambda n: [n, 0]) == [None, None]
    nulls = df.limit(5).unionByName(spark.createDataFrame([(None, None)], "h string, k string"))
    assert rows_at_hash_ranks(nulls, "h", "k", [0, 1], digits, few) == [("!", None), min((r.h, r.k) for r in df.limit(5).collect())]
    twice = df.where("k in ('1', '2')").unionByName(df.where("k = '1'"))
    assert rows_at_hash_ranks(twice, "h", "k", [0, 1, 2], digits, 1) == sorted((r.h, r.k) for r in twice.collect())


def test_splits_sort_nothing(spark, monkeypatch):
    from corpusmill.operators import rowindex

    def fail(*a, **k):
        raise AssertionError("a split sorted its rows")

    monkeypatch.setattr(rowindex, "_sorted_tagged", fail)
    out = splits.split_three_way(spark.range(1000).withColumnRenamed("id", "k"), "k", seed=3)
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 800, "test": 133, "valid": 67}
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()
