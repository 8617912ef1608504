"""Text blocks and page text of fetched pages.

Leaf mode is pure column expressions; nested mode runs the stdlib block
reader per page inside ``mapInPandas`` (Arrow batches, no shuffle). Page text
is computed per page row, so neither mode groups by URL.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusmill.functions import html as H
from corpusmill.functions.html_tree import iter_blocks
from corpusmill.functions.text import py_strip

MODES = ("nested", "leaf")
OUT_CHARS = 8 << 20     # a nested-mode task holds about this much output text
BLOCK_SCHEMA = "url string, pos bigint, tag string, text string"


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")


def _leaf_marked(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    return pages.select(F.col(url_col).alias("url"),
                        H.marked_text(F.col(html_col)).alias("_m"))


def _nested_blocks_batches(batches, flush_chars=OUT_CHARS):
    """Blocks leave in groups of about ``flush_chars``, also within one page."""
    def frame(rows):
        return pd.DataFrame(rows, columns=["url", "pos", "tag", "text"]).astype({"pos": "int64"})

    for pdf in batches:
        rows, chars = [], 0
        for url, html in zip(pdf["url"], pdf["html"]):
            for pos, (tag, raw) in enumerate(iter_blocks(html)):
                rows.append((url, pos, tag, raw.strip()))
                chars += len(raw) + 64
                if chars >= flush_chars:
                    yield frame(rows)
                    rows, chars = [], 0
        if rows:
            yield frame(rows)


def _nested_page_text_batches(batches, phrases, flush_chars=OUT_CHARS):
    """Page texts leave in groups of about ``flush_chars``; one page's text is never split."""
    for pdf in batches:
        rest, out, done, chars = pdf.drop(columns=["html"]), [], 0, 0
        for html in pdf["html"]:
            kept = (raw.strip() for _, raw in iter_blocks(html)
                    if not any(p in raw for p in phrases))
            out.append("\n".join(kept).replace("\n", " "))
            chars += len(out[-1]) + 64
            if chars >= flush_chars:
                yield rest.iloc[done:done + len(out)].assign(text=out)
                done, out, chars = done + len(out), [], 0
        if out:
            yield rest.iloc[done:].assign(text=out)


def extract_blocks(pages: DataFrame, mode: str = "nested", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """``url, pos, tag, text`` with text stripped; empty blocks kept."""
    _check(mode)
    if mode == "leaf":
        marked = _leaf_marked(pages, url_col, html_col)
        blocks = marked.select("url", F.posexplode_outer(H.leaf_blocks(F.col("_m")))
                               .alias("pos", "b"))
        return (blocks.where(F.col("pos").isNotNull())
                .select("url", F.col("pos").cast("bigint").alias("pos"),
                        F.col("b.tag").alias("tag"), py_strip(F.col("b.raw")).alias("text")))
    src = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return src.mapInPandas(lambda it: _nested_blocks_batches(it), BLOCK_SCHEMA)


def drop_blocks(blocks: DataFrame, phrases: tuple[str, ...] = H.BOILERPLATE) -> DataFrame:
    """Drop blocks whose text contains a boilerplate phrase (case-sensitive)."""
    return blocks.where(H.keep_block(F.col("text"), phrases))


def page_texts(pages: DataFrame, mode: str = "nested", url_col: str = "url",
               html_col: str = "html", phrases: tuple[str, ...] = H.BOILERPLATE,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """B3-B5 per page: ``url, *keep, text``; a page without blocks gives ``""``.

    ``keep`` carries other page columns through, so callers need no join back.
    """
    _check(mode)
    extra = [F.col(c) for c in keep]
    if mode == "leaf":
        marked = pages.select(F.col(url_col).alias("url"), *extra,
                              H.marked_text(F.col(html_col)).alias("_m"))
        return marked.select("url", *keep, H.page_text_from_blocks(
            H.leaf_blocks(F.col("_m")), phrases).alias("text"))
    src = pages.select(F.col(url_col).alias("url"), *extra, F.col(html_col).alias("html"))
    schema = StructType([f for f in src.schema.fields if f.name != "html"]
                        + [StructField("text", StringType())])
    return src.mapInPandas(lambda it: _nested_page_text_batches(it, phrases), schema)


def page_text(blocks: DataFrame, bucket: int = 256) -> DataFrame:
    """B5 over a block table: blocks in ``pos`` order joined by a space.

    Inner newlines become spaces (the reference joins with a newline and then
    replaces every newline). Uses the two-level ordered concatenation, so even
    a URL with a huge number of blocks spreads over many tasks.
    """
    flat = blocks.select("url", "pos", F.replace(F.col("text"), F.lit("\n"), F.lit(" ")).alias("text"))
    return concat_page_text(flat, key="url", page_no="pos", text="text", bucket=bucket, sep=" ")


def concat_page_text(pages: DataFrame, key: str = "url", page_no: str = "page_no",
                     text: str = "text", bucket: int = 256, sep: str = "") -> DataFrame:
    """Page texts of one document joined in page order (no separator by default).

    Two-level ordered concatenation: runs of ``bucket`` consecutive pages are
    joined first (spread over many tasks even when one document is huge),
    then the partial strings are joined per key. Each group holds at most
    ``bucket`` rows in the first level.
    """
    runs = (pages.select(F.col(key).alias("_k"), F.col(page_no).alias("_n"),
                         F.col(text).alias("_t"))
            .groupBy("_k", F.floor(F.col("_n") / bucket).alias("_r"))
            .agg(F.array_sort(F.collect_list(F.struct("_n", "_t"))).alias("_p"))
            .select("_k", "_r", F.array_join(F.col("_p._t"), sep).alias("_s")))
    return (runs.groupBy("_k")
            .agg(F.array_sort(F.collect_list(F.struct("_r", "_s"))).alias("_q"))
            .select(F.col("_k").alias(key), F.array_join(F.col("_q._s"), sep).alias(text)))
