"""D1-D5 goldens (FIXTURES K1-K19) and properties of the chunk fold."""

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, sentences_text as S
from corpusmill.operators import chunking
from corpusmill.plans import catalog

CASES = {
    "K1": ("", 50, []),
    "K2": ("no punctuation", 50, []),
    "K3": ("A. B.", 50, ["A. B."]),
    "K4": ("A. B? C!", 50, []),
    "K5": ("A. B. ", 50, []),
    "K6": (S(1, 15), 50, [S(1, 15)]),
    "K7": (S(1, 16), 50, [S(1, 15), S(1, 16)]),
    "K8": (S(1, 80), 50, [S(1, 15), S(1, 80)]),
    "K9": (S(1, 20) + " End!", 50, [S(1, 15)]),
    "K10": ("X. Y. X.", 50, ["X.", "X. Y. X."]),
    "K11": ("A. 3.14", 50, []),
    "K12": (S(1, 14) + " 3.14", 50, []),
    "K13": (S(1, 14) + " tail", 50, [S(1, 14) + " tail"]),
    "K14": (S(1, 31), 0, [S(1, 15), S(16, 30), S(31, 31)]),
    "K15": (S(1, 31), 5, [S(1, 15), S(11, 25), S(21, 31)]),
    "K16": ("A.\nB. C.", 50, ["A.\nB. C."]),
    "K17": ("\nA.", 50, ["A."]),
    "K18": ("A.  B.", 50, ["A. B."]),
}


def _chunks(spark, text, overlap=50, **kw):
    df = spark.createDataFrame([(1, "u", text)], "ord long, url string, text string")
    return [r.data for r in chunking.chunk_records(df, overlap=overlap, **kw)
            .orderBy("chunk_no").collect()]


@pytest.mark.parametrize("case", sorted(CASES))
def test_golden(spark, case):
    text, overlap, expected = CASES[case]
    assert _chunks(spark, text, overlap) == expected


def test_k19_null_url(spark):
    df = spark.createDataFrame([(1, None, "A.")], "ord long, url string, text string")
    rows = chunking.chunk_records(df).collect()
    assert [(r.url, r.data, r.chunk_no) for r in rows] == [(None, "A.", 0)]


def test_null_text_gives_nothing(spark):
    df = spark.createDataFrame([(1, "u", None)], "ord long, url string, text string")
    assert chunking.chunk_records(df).count() == 0


def test_keep_tail_option(spark):
    assert _chunks(spark, S(1, 20) + " End!", 0, keep_tail=True) == [S(1, 15), S(16, 20) + " End!"]


def test_unicode_whitespace_strip(spark):
    assert _chunks(spark, " A. ") == []          # last element "A.\xa0" lacks final "."
    assert _chunks(spark, " \x1cA. B.") == ["A. B."]    # strip removes what str.strip removes


def test_input_contract(spark):
    df = spark.createDataFrame([(1,)], "ord long")
    with pytest.raises(ValueError):
        chunking.chunk_records(df)


def test_chunks_are_substrings_of_rejoined_sentences(spark):
    recs = catalog._records(spark, SF_SMALL)
    chunks = chunking.chunk_records(recs, overlap=5)
    joined = catalog._records(spark, SF_SMALL).select(
        F.col("ord"), F.array_join(chunking.split_sentences(F.col("text")), " ").alias("j"))
    bad = chunks.join(joined, "ord").where(~F.col("j").contains(F.col("data")))
    assert bad.count() == 0


def test_default_gives_at_most_two_chunks_without_repeats(spark):
    recs = catalog._records(spark, SF_SMALL)
    per_doc = chunking.chunk_records(recs).groupBy("ord").count()
    assert per_doc.agg(F.max("count")).first()[0] <= 3


def test_no_python_and_no_single_partition(spark):
    plan = catalog.chunks_default(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "Exchange" not in plan          # chunking never shuffles
