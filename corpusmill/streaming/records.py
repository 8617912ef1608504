"""H1, H2: the crawl sink and the preparation as Structured Streaming queries.

H1 keeps the first record per URL, exactly and across restarts (the reference's visited
set + append file): a micro-batch keeps the first record of each of its URLs and drops
URLs that earlier batches committed. What it remembers is the sink itself, a table of
URLs; it grows with the distinct URLs, as there is no event time to bound it by.

H2 turns new records into chat examples, each key once, with any generator. Every step
before the generator is row-wise (split, fold, posexplode, prompt columns); look-back
over other documents (E1, k > 0) and the exact split (F1/F2) need the whole table and
stay batch-only.

Both sinks are slice stores: a micro-batch is a slice named by the stream's id and the
batch's number, so a batch that Spark runs again after a crash replaces what it had
written, or does nothing if it was committed.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.functions.prompts import chat_messages
from corpusmill.operators import chunking, qa
from corpusmill.operators.splits import hash_split
from corpusmill.plans import workflows
from corpusmill.session import cut_lineage
from corpusmill.sources.slices import COMMIT, SliceStore

STREAM_RECORD_DDL = "url string, text string, ord bigint"


def record_stream(spark: SparkSession, source_dir: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(STREAM_RECORD_DDL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    recs = reader.json(source_dir)
    # records without an explicit order key get a stable one from the url
    return recs.withColumn("ord", F.coalesce(F.col("ord"), F.xxhash64("url")))


RECORD_PARTS = {"records": "url string, text string, ord bigint", "urls": "url string"}


def record_store(spark: SparkSession, path: str) -> SliceStore:
    return SliceStore(spark, path, RECORD_PARTS, {"records": "json"})


def _slice_name(spark: SparkSession, checkpoint_dir: str, batch_id: int) -> str:
    """The stream's id outlives restarts; a new checkpoint folder is a new stream."""
    about = spark.read.text(f"{checkpoint_dir.rstrip('/')}/metadata").first()[0]
    return f"{json.loads(about)['id']}-{batch_id:09d}"


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint_dir: str, available_now: bool,
           name: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_dir)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def first_records(spark: SparkSession, source_dir: str, store_dir: str, checkpoint_dir: str,
                  available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """H1: the first record of every URL, across micro-batches and restarts.

    Batches come first to last; within one the least ``ord`` decides, then (and where
    records have none) the place in the files: modification time, path, position. A null
    URL is a URL like any other. The counters ``records.read`` and ``records.without_text``
    of each batch reach ``BatchCounters``. Read the result from ``record_store(...).read("records")``.
    """
    reader = spark.readStream.schema(STREAM_RECORD_DDL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.json(source_dir).select("*", "_metadata.file_modification_time", "_metadata.file_path",
                                            "_metadata.file_block_start")
    stream = stream.observe("records", F.count(F.lit(1)).alias("read"), F.count_if(F.col("text").isNull()).alias("without_text"))

    def each(batch: DataFrame, batch_id: int) -> None:
        store = record_store(batch.sparkSession, store_dir)
        name = _slice_name(batch.sparkSession, checkpoint_dir, batch_id)
        if name in store.entries(COMMIT):
            return
        placed = batch.withColumn("_at", F.monotonically_increasing_id())
        order = F.struct(F.col("ord").isNull(), "ord", "file_modification_time", "file_path", "file_block_start", "_at")
        # a partial aggregate: a hot URL sends one row per task
        firsts = placed.groupBy("url").agg(F.min_by(F.struct("text", "ord"), order).alias("r"))
        seen = store.read("urls").select(F.col("url").alias("_seen"))
        new = cut_lineage(firsts.join(seen, F.col("url").eqNullSafe(F.col("_seen")), "left_anti")
                          .select("url", "r.text", "r.ord"))
        store.commit(name, {"records": new, "urls": new})

    return _start(stream, each, checkpoint_dir, available_now)


def generate_stream(spark: SparkSession, source_dir: str, store_dir: str, checkpoint_dir: str,
                    cfg: workflows.PrepareConfig | None = None, available_now: bool = True,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """H2 with a plug-in generator: examples of new records, each key generated and committed once.

    A batch leaves out keys that are committed, whatever stream or batch run committed
    them. Calls that fail (``cfg.on_error="row"``) stay pending in the store:
    ``workflows.retry_failed`` makes just those again. ``cfg.look_back`` must be 0.
    """
    cfg = cfg or workflows.PrepareConfig(on_error="row")
    if cfg.look_back:
        raise ValueError("look-back over other documents needs the whole table")

    def each(batch: DataFrame, batch_id: int) -> None:
        store = workflows.example_store(batch.sparkSession, store_dir, cfg.max_records_per_file)
        name = _slice_name(batch.sparkSession, checkpoint_dir, batch_id)
        if name in store.entries(COMMIT):
            return
        # a chunk at a time up to the generator: its context is shuffled once, not once per question
        chunks = (workflows.chunk_contexts(batch, cfg).select(*qa.WORK_KEYS[:2], "url", "context")
                  .dropDuplicates(list(qa.WORK_KEYS[:2])))
        work = qa.expand_slots(qa.open_slots(chunks, store.read("keys"), cfg.questions))
        store.commit(name, workflows.example_parts(work, cfg))

    return _start(record_stream(spark, source_dir, max_files_per_trigger), each, checkpoint_dir, available_now)


def example_stream(records: DataFrame, size: int = chunking.DEFAULT_SIZE,
                   overlap: int = chunking.DEFAULT_OVERLAP, questions: int = 2) -> DataFrame:
    """H2 transformation: records -> chunks -> stub QA -> chat examples (row-wise)."""
    chunks = chunking.chunk_records(records, size, overlap)
    work = qa.expand_questions(qa.lookback_context(chunks, 0), questions)
    rows = qa.generate_qa(work)
    return rows.select(*qa.WORK_KEYS, "url",
                       chat_messages(F.col("question"), F.col("answer")).alias("messages"))


def prepare_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                   available_now: bool = True, split_seed: int | None = None) -> StreamingQuery:
    """H2: each input record is turned into examples exactly once across restarts.

    With ``split_seed`` each example also gets an approximate ``split``
    (hash threshold); the exact split needs the whole table and is batch-only.
    """
    out = example_stream(record_stream(spark, source_dir))
    if split_seed is not None:
        key = F.concat_ws(":", *[F.col(k).cast("string") for k in qa.WORK_KEYS])
        out = out.withColumn("split", hash_split(key, split_seed))
    writer = (out.writeStream.format("parquet")
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(sink_dir)
