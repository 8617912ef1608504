"""Plan checks: no single-partition exchange, pruned scans, native operators stay native."""

import pytest

import __spark_entry__ as E
from helpers import SF_SMALL

NATIVE = ["chunks_default", "chunks_no_overlap", "sentences", "blocks_leaf", "page_text_leaf",
          "links", "links_allowed", "preview", "quotes", "file_key", "content_kind",
          "prompts_question", "qa_stub", "chat_examples"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_single_partition_only_for_partial_global_aggregates(spark, name):
    """A single-partition exchange may only carry one partial-aggregate row per task."""
    lines = _plan(E.queries()[name](spark, SF_SMALL)).split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            assert "HashAggregate(keys=[]" in below and "partial_" in below, (name, below)


@pytest.mark.parametrize("name", NATIVE)
def test_native_operators_have_no_python_and_no_shuffle(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "Python" not in plan and "ArrowEval" not in plan and "MapInPandas" not in plan
    assert "Exchange" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["chunks_default"](spark, SF_SMALL))
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "lang" not in schema and "n_chars" not in schema
    plan = _plan(E.queries()["file_key"](spark, SF_SMALL))
    assert "html" not in plan.split("ReadSchema: ")[1].split("\n")[0]


def test_filter_pushdown_reaches_scan(spark):
    from pyspark.sql import functions as F
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet").where(F.col("url").startswith("https"))
    assert "StringStartsWith(url,https)" in _plan(df)


def test_crawl_round_shuffles_only_candidates(spark):
    from pyspark.sql import functions as F

    from corpusmill.operators import crawl as C
    from corpusmill.plans import catalog
    from corpusmill.session import checkpoint_partitioned, session_conf

    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        pages = catalog.linked_pages(spark, SF_SMALL)
        edges = checkpoint_partitioned(C.link_graph(pages, catalog.TEST_POLICY), 8, "src", sort=True)
        seeds = pages.select("url").withColumn("depth", F.lit(0))
        front = checkpoint_partitioned(seeds, 8, "url", sort=True)
        visited = C._Visited(front, 8, 8)
        visited.add(checkpoint_partitioned(front.withColumn("depth", F.lit(1)), 8, "url", sort=True))
        step = (front.select(F.col("url").alias("src")).join(edges, "src")
                .select(F.col("dst").alias("url")).distinct())
        with session_conf(spark, {"spark.sql.adaptive.enabled": "false",
                                  "spark.sql.shuffle.partitions": "8"}):
            plan = _plan(visited.exclude(step))
    assert plan.count("Exchange") == 1              # the candidate dedupe only
    assert plan.count("Sort [") == 1                # the candidates only
