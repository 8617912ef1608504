"""The reference's end-to-end runs as compositions of the operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.prompts import chat_messages
from corpusmill.functions.web import UrlPolicy
from corpusmill.operators import chunking, crawl as C, qa, splits
from corpusmill.operators.rowindex import with_row_index
from corpusmill.session import cut_lineage
from corpusmill.schemas import MESSAGES_TYPE
from corpusmill.sources import export, records as R
from corpusmill.sources.slices import SliceStore, commit_in_slices


@dataclass
class PrepareConfig:
    """Knobs of G2; defaults are the reference's values."""

    size: int = chunking.DEFAULT_SIZE
    overlap: int = chunking.DEFAULT_OVERLAP
    look_back: int = 0
    questions: int = 2
    seed: int = 0
    group: str | None = None            # F4: split by group instead of by example
    generator: Callable[[pd.DataFrame], pd.DataFrame] | None = None
    generator_partitions: int | None = None
    max_records_per_file: int | None = None
    slices: int = 8                     # E8: commits that the pending work of a run is cut into
    on_error: str = "raise"             # E5: "row" keeps failed calls pending instead of ending the run


EXAMPLE_PARTS = {
    "examples": f"ord bigint, chunk_no bigint, question_no bigint, url string, messages {MESSAGES_TYPE}",
    "keys": "ord bigint, chunk_no bigint, question_no bigint",
    "failed": "ord bigint, chunk_no bigint, question_no bigint, url string, context string, error string",
}


# Staged work: a chunk and the question slots it still needs; runs and retries go on with each other's.
_CHUNK = list(qa.WORK_KEYS[:2])
_STAGED = [*_CHUNK, "url", "context", "questions"]


def example_store(spark: SparkSession, path: str, max_records_per_file: int | None = None) -> SliceStore:
    """The committed examples of all runs: JSON lines (A5, with their keys), keys alone, and failed calls."""
    options = {"maxRecordsPerFile": str(max_records_per_file)} if max_records_per_file else {}
    return SliceStore(spark, path, EXAMPLE_PARTS, {"examples": "json"}, options)


def example_parts(work: DataFrame, cfg: PrepareConfig) -> dict[str, DataFrame]:
    """E5 + E6 over a slice of work: the parts of ``example_store``. Every call is made once."""
    rows = qa.generate_qa(work, cfg.generator, partitions=cfg.generator_partitions, on_error=cfg.on_error)
    if cfg.on_error == "raise":
        rows = rows.withColumn("status", F.lit("ok")).withColumn("error", F.lit(None).cast("string"))
    context = F.when(F.col("status") != "ok", F.col("context")).alias("context")         # only failed calls need it again
    rows = cut_lineage(rows.select(*qa.WORK_KEYS, "url", context, "question", "answer", "status", "error"))
    ok = rows.where(F.col("status") == "ok")
    return {"examples": ok.withColumn("messages", chat_messages(F.col("question"), F.col("answer"))),
            "keys": ok, "failed": rows.where(F.col("status") != "ok")}


def generate_in_slices(records: DataFrame, store: SliceStore, cfg: PrepareConfig,
                       stop_after: int | None = None) -> list[str]:
    """E7 + E8: make the examples still pending, committing slice by slice; returns the slices committed.

    A run that ended early, by ``stop_after`` or by a crash, goes on where it ended; keys
    that are committed are never generated again, failed ones are pending again. Work is
    staged a chunk at a time with its open question slots, so a context is shuffled and
    written once however many questions it gets.
    """
    def todo() -> DataFrame:
        chunks = chunk_contexts(records, cfg).select(*_CHUNK, "url", "context")
        return qa.open_slots(chunks, store.read("keys"), cfg.questions).select(*_STAGED)

    return commit_in_slices(store, todo, _CHUNK, cfg.slices, lambda rows: example_parts(qa.expand_slots(rows), cfg), stop_after)


def failed_calls(store: SliceStore) -> DataFrame:
    """Work whose calls failed and that no later run has done: one row per key."""
    return qa.pending(store.read("failed").drop("slice").dropDuplicates(list(qa.WORK_KEYS)), store.read("keys"))


def retry_failed(store: SliceStore, cfg: PrepareConfig, stop_after: int | None = None) -> list[str]:
    """Call the generator again for failed work alone, from the stored contexts."""
    def todo() -> DataFrame:
        return failed_calls(store).withColumn("questions", F.array("question_no")).select(*_STAGED)

    return commit_in_slices(store, todo, _CHUNK, cfg.slices, lambda rows: example_parts(qa.expand_slots(rows), cfg), stop_after)


def example_key() -> F.Column:
    return F.concat_ws(":", *[F.col(k).cast("string") for k in qa.WORK_KEYS])


def chunk_contexts(records: DataFrame, cfg: PrepareConfig) -> DataFrame:
    """D5 + E1: one row per chunk with its context."""
    chunks = chunking.chunk_records(records, cfg.size, cfg.overlap)
    return qa.lookback_context(chunks, cfg.look_back)


def chunk_work(records: DataFrame, cfg: PrepareConfig) -> DataFrame:
    """D5 + E1 + E2: one row per (chunk, question slot) with its context."""
    return qa.expand_questions(chunk_contexts(records, cfg), cfg.questions)


def generate_examples(work: DataFrame, cfg: PrepareConfig,
                      done: DataFrame | None = None) -> DataFrame:
    """Chat examples for the work not done yet (keys + url + messages)."""
    todo = qa.pending(work, done) if done is not None else work
    rows = qa.generate_qa(todo, cfg.generator, partitions=cfg.generator_partitions)
    return rows.select(*qa.WORK_KEYS, "url",
                       chat_messages(F.col("question"), F.col("answer")).alias("messages"))


def split_examples(examples: DataFrame, cfg: PrepareConfig) -> DataFrame:
    """F2 or F4 on a materialized example table; adds ``split``."""
    if cfg.group:
        return splits.split_grouped(examples, cfg.group, cfg.seed)
    keyed = examples.withColumn("_key", example_key())
    return splits.split_three_way(keyed, "_key", cfg.seed).drop("_key")


def prepare(records: DataFrame, cfg: PrepareConfig | None = None,
            examples_path: str | None = None, out_dir: str | None = None,
            generate: bool = True) -> DataFrame:
    """Records -> chunks -> examples -> train/test/valid.

    With ``examples_path`` the examples are committed there in ``cfg.slices`` slices
    (E8; keys already committed are skipped) and the split reads them back, as the
    reference does; otherwise they are checkpointed. ``generate=False`` only
    re-splits the existing examples. With ``out_dir`` the splits are written.
    """
    cfg = cfg or PrepareConfig()
    spark = records.sparkSession
    if not generate and examples_path is None:
        raise ValueError("generate=False needs examples_path: there are no examples to split")
    if examples_path is not None:
        store = example_store(spark, examples_path, cfg.max_records_per_file)
        if generate:
            generate_in_slices(records, store, cfg)
        examples = store.read("examples").drop("slice")
    else:
        examples = cut_lineage(generate_examples(chunk_work(records, cfg), cfg))
    result = split_examples(examples, cfg)
    if out_dir is not None:
        R.write_splits(result, out_dir)
    return result


def crawl_and_save(seeds: DataFrame, pages: DataFrame | None, policy: UrlPolicy, out_path: str,
                   mode: str = "drop", html_mode: str = "nested",
                   max_depth: int | None = None, content_type_col: str | None = None,
                   pdf_texts: DataFrame | None = None,
                   fetch: Callable[[pd.DataFrame], pd.DataFrame] | None = None) -> DataFrame:
    """G1: crawl from the seeds and write one record per fetched page (A2).

    With ``pages`` the crawl reads a store of fetched pages; with ``fetch`` it
    fetches each round's frontier live through the caller's function.
    """
    if fetch is not None:
        visited, fetched = C.crawl_fetching(seeds, fetch, policy, mode=mode, max_depth=max_depth)
        recs = C.crawl_records(visited, fetched, mode=html_mode, content_type_col="content_type",
                               pdf_texts=pdf_texts, html_col="body")
    else:
        if pages is None:
            raise ValueError("a crawl needs a page store or a fetch function")
        visited = C.crawl(seeds, pages, policy, mode=mode, max_depth=max_depth)
        recs = C.crawl_records(visited, pages, mode=html_mode,
                               content_type_col=content_type_col, pdf_texts=pdf_texts)
    R.write_records(recs.select("url", "text"), out_path, mode="overwrite")
    return visited


def records_with_order(records: DataFrame) -> DataFrame:
    """Give read-back records a repeatable order key (by url, then text hash)."""
    if "ord" in records.columns:
        return records
    keyed = records.withColumn("_h", F.md5(F.coalesce(F.col("text"), F.lit(""))))
    return with_row_index(keyed, ["url", "_h"], "ord").drop("_h")


@dataclass
class RunConfig:
    """G3 switches; training itself is outside this library."""

    records_path: str
    out_dir: str
    examples_path: str | None = None
    use_backup: bool = True             # skip the crawl, read existing records
    generate: bool = True
    train: bool = True                  # False skips preparation entirely
    seeds: list[str] = field(default_factory=list)
    pages: DataFrame | None = None
    fetch: Callable[[pd.DataFrame], pd.DataFrame] | None = None
    policy: UrlPolicy = field(default_factory=UrlPolicy)
    link_mode: str = "drop"             # B9: the reference keeps absolute links only
    html_mode: str = "nested"
    max_depth: int | None = None
    content_type_col: str | None = None  # of ``pages``; without it every page is HTML
    pdf_texts: DataFrame | None = None
    prepare: PrepareConfig = field(default_factory=PrepareConfig)


def run(spark: SparkSession, cfg: RunConfig) -> DataFrame | None:
    """Crawl unless a backup is used, then prepare unless training is off."""
    if not cfg.use_backup:
        crawl_and_save(C.seed_urls(spark, cfg.seeds), cfg.pages, cfg.policy, cfg.records_path,
                       mode=cfg.link_mode, html_mode=cfg.html_mode, max_depth=cfg.max_depth,
                       content_type_col=cfg.content_type_col, pdf_texts=cfg.pdf_texts, fetch=cfg.fetch)
    if not cfg.train:
        return None
    records = R.read_records_in_order(spark, cfg.records_path)
    return prepare(records, cfg.prepare, cfg.examples_path, cfg.out_dir, cfg.generate)


def export_documents(spark: SparkSession, records_path: str, out_dir: str,
                     max_len: int = 50) -> None:
    """Read records, one text file per sanitised URL, the last record in file order wins."""
    records = R.read_records_in_order(spark, records_path)
    export.export_documents(records, out_dir, max_len)


def with_metrics(df: DataFrame, name: str, **counts: F.Column) -> tuple[DataFrame, Observation]:
    """Progress counters collected with the job itself (no extra pass).

    ``counts`` maps a metric name to a boolean column counted with count_if;
    ``rows`` is always included. Read ``observation.get`` after an action.
    """
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")]
    exprs += [F.count_if(c).alias(k) for k, c in counts.items()]
    return df.observe(obs, *exprs), obs
