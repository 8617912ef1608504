"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables (or data Spark derives from them) in
full; column names match the oracle SQL in ``corpusmill.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import prompts as _prompts
from corpusmill.functions import text as _text
from corpusmill.functions.web import UrlPolicy, content_kind as _content_kind
from corpusmill.operators import blocks as _blocks, links as _links
from corpusmill.operators import chunking
from corpusmill.operators import crawl as _crawl
from corpusmill.operators import qa as _qa
from corpusmill.operators import splits as _splits
from corpusmill.session import read_table
from corpusmill.sources import export as _export
from corpusmill.sources.records import records_from_documents


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_from_documents(read_table(spark, sf_dir, "documents"))


def chunks_default(spark, sf_dir):
    return chunking.chunk_records(_records(spark, sf_dir))


def chunks_no_overlap(spark, sf_dir):
    return chunking.chunk_records(_records(spark, sf_dir), overlap=0)


def chunks_overlap5(spark, sf_dir):
    return chunking.chunk_records(_records(spark, sf_dir), overlap=5)


def chunks_keep_tail(spark, sf_dir):
    return chunking.chunk_records(_records(spark, sf_dir), overlap=5, keep_tail=True)


def sentences(spark, sf_dir):
    return chunking.sentences(_records(spark, sf_dir))


_CHUNK_QUERIES = {
    "chunks_keep_tail": chunks_keep_tail,
    "chunks_default": chunks_default,
    "chunks_no_overlap": chunks_no_overlap,
    "chunks_overlap5": chunks_overlap5,
    "sentences": sentences,
}


# ---------------------------------------------------------------- pages, links


# Fixed test policy for the driver tables.
TEST_POLICY = UrlPolicy(deny_substrings=("cheap-pills", "spam-farm"),
                        deny_patterns=("example.com/fr",), require_pattern="example")
# Fixed stand-in content types, assigned by page_id % 4.
TEST_CONTENT_TYPES = ("text/html", "text/html; charset=utf-8", "application/pdf", None)


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages")


def _typed_pages(spark, sf_dir):
    p = _pages(spark, sf_dir)
    m = F.col("page_id") % 4
    ct = F.when(m == 0, TEST_CONTENT_TYPES[0]).when(m == 1, TEST_CONTENT_TYPES[1]) \
          .when(m == 2, TEST_CONTENT_TYPES[2]).otherwise(F.lit(None).cast("string"))
    return p.withColumn("content_type", ct)


def content_kind(spark, sf_dir):
    p = _typed_pages(spark, sf_dir)
    return p.select("page_id", "content_type", _content_kind("content_type").alias("kind"))


def blocks_leaf(spark, sf_dir):
    return _blocks.extract_blocks(_pages(spark, sf_dir), mode="leaf")


def blocks_nested(spark, sf_dir):
    return _blocks.extract_blocks(_pages(spark, sf_dir), mode="nested")


def page_text_leaf(spark, sf_dir):
    return _blocks.page_texts(_pages(spark, sf_dir), mode="leaf")


def page_text_nested(spark, sf_dir):
    return _blocks.page_texts(_pages(spark, sf_dir), mode="nested")


def page_concat(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    return _blocks.concat_page_text(conv, key="conv_id", page_no="turn", text="text")


def links(spark, sf_dir):
    return _links.extract_links(_pages(spark, sf_dir))


def links_concat(spark, sf_dir):
    return _links.absolute_links(_links.extract_links(_pages(spark, sf_dir)), mode="concat")


def links_resolved(spark, sf_dir):
    return _links.absolute_links(_links.extract_links(_pages(spark, sf_dir)), mode="resolve")


def links_allowed(spark, sf_dir):
    return _links.classify_links(links_resolved(spark, sf_dir), TEST_POLICY) \
        .select("src", "pos", "dst", "allowed")


def link_stats(spark, sf_dir):
    return _links.link_stats(_links.classify_links(links_resolved(spark, sf_dir), TEST_POLICY))


def links_distinct(spark, sf_dir):
    return _links.distinct_links(links_resolved(spark, sf_dir))


_PAGE_QUERIES = {
    "content_kind": content_kind,
    "blocks_leaf": blocks_leaf,
    "blocks_nested": blocks_nested,
    "page_text_leaf": page_text_leaf,
    "page_text_nested": page_text_nested,
    "page_concat": page_concat,
    "links": links,
    "links_concat": links_concat,
    "links_resolved": links_resolved,
    "links_allowed": links_allowed,
    "link_stats": link_stats,
    "links_distinct": links_distinct,
}


# ------------------------------------------------------ text functions, export


def preview(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", _text.preview("text", 60).alias("preview"))


def quotes(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    curly = F.replace(F.replace(F.col("text"), F.lit(","), F.lit("\u2019")),
                      F.lit("\u00e9"), F.lit("\u201c"))
    return d.select("doc_id", _text.normalize_quotes(curly).alias("text"))


def file_key(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", "url", _text.file_key("url", 50).alias("key50"),
                    _text.file_key("url", 20).alias("key20"))


def export_table(spark, sf_dir):
    records = _blocks.page_texts(_pages(spark, sf_dir), mode="leaf", keep=("page_id",))
    return _export.export_table(records.withColumnRenamed("page_id", "ord"), max_len=20)


# ------------------------------------------------------------------- crawl


def linked_pages(spark, sf_dir):
    """Pages whose bodies also link page p to pages 2p+1, 3p+1 and p div 2."""
    p = _pages(spark, sf_dir)
    ids = p.select(F.col("page_id").alias("dst_id"), F.col("url").alias("dst_url"))
    targets = p.select(F.col("page_id").alias("src_id"), F.posexplode(F.array(
        2 * F.col("page_id") + 1, 3 * F.col("page_id") + 1,
        F.floor(F.col("page_id") / 2))).alias("k", "dst_id"))
    anchors = (targets.join(ids, "dst_id")
               .groupBy("src_id")
               .agg(F.array_sort(F.collect_list(F.struct(
                   "k", F.concat(F.lit('<a href="'), "dst_url", F.lit('"></a>')).alias("a"))))
                   .alias("_a"))
               .select(F.col("src_id").alias("page_id"),
                       F.array_join(F.col("_a.a"), "").alias("_extra")))
    return (p.join(anchors, "page_id", "left")
            .select("page_id", "url",
                    F.concat(F.col("html"), F.coalesce(F.col("_extra"), F.lit(""))).alias("html")))


def links_drop(spark, sf_dir):
    """The default mode over bodies with absolute and relative links: the scheme filter drops the latter."""
    return _links.absolute_links(_links.extract_links(linked_pages(spark, sf_dir)), mode="drop")


def _seed(pages):
    return pages.orderBy("page_id").limit(1).select("url")


def crawl(spark, sf_dir):
    pages = linked_pages(spark, sf_dir)
    return _crawl.crawl(_seed(pages), pages, TEST_POLICY, mode="resolve") \
        .select("url", F.col("depth").cast("bigint").alias("depth"))


def crawl_records(spark, sf_dir):
    pages = linked_pages(spark, sf_dir)
    visited = _crawl.crawl(_seed(pages), pages, TEST_POLICY, mode="resolve")
    return _crawl.crawl_records(visited, pages, mode="leaf").select("url", "text")


def fetch_pages(spark, sf_dir):
    frontier = links_resolved(spark, sf_dir).select(F.col("dst").alias("url")).distinct()
    frontier = frontier.unionByName(_pages(spark, sf_dir).select("url"))
    fetched = _crawl.fetch_pages(frontier.distinct(), _pages(spark, sf_dir))
    return fetched.select("url", "found", F.length("html").cast("bigint").alias("n_chars"))


def unvisited(spark, sf_dir):
    edges = _crawl.link_graph(linked_pages(spark, sf_dir), TEST_POLICY)
    frontier = edges.select(F.col("dst").alias("url"))
    return _crawl.unvisited(frontier, _pages(spark, sf_dir).select("url"))


# ------------------------------------------------------------ batches, splits

SPLIT_SEED = 42


def batches(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id")
    return _splits.assign_batches(d, ["doc_id"], 8)


def split_three_way(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id")
    return _splits.split_three_way(d, "doc_id", seed=SPLIT_SEED)


def split_exact(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id")
    return _splits.split_exact(d, "doc_id", seed=SPLIT_SEED)


def shuffle_rank(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id")
    return _splits.shuffle_rank(d, "doc_id", seed=SPLIT_SEED)


def split_grouped(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return _splits.split_grouped(d, "source", seed=SPLIT_SEED)


# ---------------------------------------------------------------- QA family


def _work(spark, sf_dir):
    chunks = chunking.chunk_records(_records(spark, sf_dir))
    return _qa.expand_questions(_qa.lookback_context(chunks, 0), 2)


def prompts_question(spark, sf_dir):
    w = _work(spark, sf_dir).withColumn("m", _prompts.question_messages(F.col("context")))
    return w.select("ord", "chunk_no", "question_no",
                    F.col("m")[0]["content"].alias("system"), F.col("m")[1]["content"].alias("user"))


def prompts_answer(spark, sf_dir):
    qa = _qa.generate_qa(_work(spark, sf_dir))
    w = qa.withColumn("m", _prompts.answer_messages(F.col("question"), F.col("context")))
    return w.select("ord", "chunk_no", "question_no",
                    F.col("m")[0]["content"].alias("system"), F.col("m")[1]["content"].alias("user"))


def qa_stub(spark, sf_dir):
    return _qa.generate_qa(_work(spark, sf_dir)).select(*_qa.WORK_KEYS, "question", "answer")


def chat_examples(spark, sf_dir):
    ex = _qa.to_examples(_qa.generate_qa(_work(spark, sf_dir)))
    m = F.col("messages")
    return ex.select(*_qa.WORK_KEYS, m[0]["content"].alias("system"),
                     m[1]["content"].alias("user"), m[2]["content"].alias("assistant"))


def _done(spark, sf_dir):
    """Stand-in progress: an earlier run wrote the examples of the English documents."""
    english = read_table(spark, sf_dir, "documents").where(F.col("lang") == "en")
    chunks = chunking.chunk_records(records_from_documents(english))
    return _qa.expand_questions(chunks, 2).select(*_qa.WORK_KEYS)


def pending(spark, sf_dir):
    w = _work(spark, sf_dir).select(*_qa.WORK_KEYS)
    return _qa.pending(w, _done(spark, sf_dir))


def resume_status(spark, sf_dir):
    w = _work(spark, sf_dir).select(*_qa.WORK_KEYS)
    return _qa.resume_status(w, _done(spark, sf_dir))


def _turns(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select(F.col("conv_id").alias("ord"), F.col("turn").alias("chunk_no"),
                       F.col("text").alias("data"))


def lookback(spark, sf_dir):
    ctx = _qa.lookback_context(_turns(spark, sf_dir), k=2)
    return ctx.select(F.col("ord").alias("conv_id"), F.col("chunk_no").alias("turn"), "context")


def lookback_within(spark, sf_dir):
    ctx = _qa.lookback_context(_turns(spark, sf_dir), k=2, within="ord")
    return ctx.select(F.col("ord").alias("conv_id"), F.col("chunk_no").alias("turn"), "context")


_MORE_QUERIES = {
    "preview": preview,
    "quotes": quotes,
    "file_key": file_key,
    "export_table": export_table,
    "links_drop": links_drop,
    "crawl": crawl,
    "crawl_records": crawl_records,
    "fetch_pages": fetch_pages,
    "unvisited": unvisited,
    "batches": batches,
    "split_three_way": split_three_way,
    "split_grouped": split_grouped,
    "split_exact": split_exact,
    "shuffle_rank": shuffle_rank,
    "prompts_question": prompts_question,
    "prompts_answer": prompts_answer,
    "qa_stub": qa_stub,
    "chat_examples": chat_examples,
    "pending": pending,
    "resume_status": resume_status,
    "lookback": lookback,
    "lookback_within": lookback_within,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_CHUNK_QUERIES, **_PAGE_QUERIES, **_MORE_QUERIES}


# ---------------------------------------------------------------- G2 prepare
def prepare(spark, sf_dir):
    from corpusmill.plans import workflows
    cfg = workflows.PrepareConfig(seed=SPLIT_SEED)
    out = workflows.prepare(_records(spark, sf_dir), cfg)
    m = F.col("messages")
    return out.select(*_qa.WORK_KEYS, "split", m[1]["content"].alias("user"),
                      m[2]["content"].alias("assistant"))


_MORE_QUERIES["prepare"] = prepare
