"""Records and chat examples as JSON text, plus the test-table stand-ins."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.rowindex import with_total_before
from corpusmill.schemas import EXAMPLE_DDL, RECORD_DDL
from corpusmill.session import cut_lineage

# Fixed value: url prefix of the document stand-in records.
DOC_URL_PREFIX = "https://docs.example.com/"


def records_from_documents(documents: DataFrame) -> DataFrame:
    """Records (``ord, url, text``) from the ``documents`` table."""
    return documents.select(
        F.col("doc_id").alias("ord"),
        F.concat(F.lit(DOC_URL_PREFIX), F.col("source"), F.lit("/"),
                 F.col("doc_id").cast("string")).alias("url"),
        F.col("text"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A1: blank-line separated JSON objects ``{"url", "text"}``; bad JSON fails.

    Blank lines are skipped by the line reader; escaped newlines inside values
    are part of one JSON line, so the blank-line format reads as JSON lines.
    """
    return spark.read.schema(RECORD_DDL).option("mode", "FAILFAST").json(path)


def read_records_in_order(spark: SparkSession, path: str) -> DataFrame:
    """A1 with ``ord``: the record's number in file order (files by path, lines as they stand).

    Each split of a file knows its path and first byte, and its rows come in line order, so
    only the number of records per split has to be summed up: no text is sorted, and the
    numbers don't depend on how files are cut into splits.
    """
    rows = read_records(spark, path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"))
    splits = cut_lineage(rows.groupBy("_file", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")))
    placed = with_total_before(splits, ["_file", "_start"], "_n", "_before")         # a row per split, not per record
    # so few that every task gets them all: records stay where they were read
    return rows.join(F.broadcast(placed.drop("_n")), ["_file", "_start"]).select(
        (F.col("_before") + F.col("_at") - F.col("_first")).alias("ord"), "url", "text")


def write_records(df: DataFrame, path: str, mode: str = "append") -> None:
    """A2/A3: one JSON object per record followed by a blank line.

    ``mode="overwrite"`` empties the sink explicitly (A3) instead of at import.
    """
    (df.select(F.to_json(F.struct("url", "text")).alias("value"))
       .write.mode(mode).option("lineSep", "\n\n").text(path))


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """A4: chat examples, one JSON object per line."""
    return spark.read.schema(EXAMPLE_DDL).option("mode", "FAILFAST").json(path)


def write_examples(df: DataFrame, path: str, mode: str = "append",
                   max_records_per_file: int | None = None) -> None:
    """Append chat examples; each task commits its file atomically."""
    writer = df.select("messages").write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.json(path)


SPLITS = ("train", "test", "valid")


def write_splits(df: DataFrame, out_dir: str, split_col: str = "split") -> None:
    """``train``/``test``/``valid`` folders of JSON lines, overwritten.

    One pass: the split column becomes the folder partition. A split without rows
    gets a folder without rows, so readers find all three.
    """
    spark, out = df.sparkSession, out_dir.rstrip("/")
    rows = df.select("messages", F.col(split_col).alias("split"))
    rows.write.mode("overwrite").partitionBy("split").json(out)
    for split in SPLITS:
        try:
            spark.read.text(f"{out}/split={split}")                  # resolves the folder, reads nothing
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            spark.createDataFrame([], rows.drop("split").schema).write.mode("overwrite").json(f"{out}/split={split}")
