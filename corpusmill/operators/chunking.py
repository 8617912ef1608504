"""Sentence chunks of records.

The chunk rule is a left fold over a document's sentences. It is evaluated
with the ``aggregate`` higher-order function inside the projection, so a
document never leaves its task and no shuffle or Python worker is involved.
The fold carries only integer positions (start of the current unit list and
the emitted spans); sentence text is sliced once per emitted chunk.

When the overlap is at least the chunk size (the default), the list is never
cut below the size after the first emit, so the emit positions have a closed
form: unit ``size`` (unless it is a decimal) and every unit that ends in
``.`` and equals the last sentence. A chunk then starts at
``max(1, previous emit - overlap + 1)``. That path needs one ``filter`` and
one ``transform`` instead of the fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import is_decimal, py_strip, split_sentences

# Fixed values of the reference chunker.
DEFAULT_SIZE = 15      # sentences per chunk
DEFAULT_OVERLAP = 50   # sentences kept after an emit

_SPAN = "struct<st:int,u:int>"


def chunk_spans(sentences: Column, size: int = DEFAULT_SIZE,
                overlap: int = DEFAULT_OVERLAP, keep_tail: bool = False) -> Column:
    """Emitted (start, end) sentence positions, 1-based and inclusive.

    Unit u fires when it is not a decimal and either the current list holds
    ``size`` units or it ends in ``.`` and equals the text's last sentence by
    value. After a fire the list keeps its last ``overlap`` units.
    """
    if size < 1 or overlap < 0:
        raise ValueError("size must be >= 1 and overlap >= 0")
    s = sentences
    n = F.size(s)
    last = F.element_at(s, -1)
    init = F.struct(F.lit(1).alias("st"), F.expr(f"CAST(array() AS array<{_SPAN}>)").alias("e"))

    def step(acc: Column, u: Column) -> Column:
        x = F.element_at(s, u)
        # a decimal never ends in ".", so the regex is needed only for the size test,
        # and it runs after the cheap comparison (at most once per document)
        fire = (((u - acc["st"] + 1) == F.lit(size)) & ~is_decimal(x)) | (
            x.endswith(".") & (x == last))
        fired = F.struct(
            F.greatest(acc["st"], u - F.lit(overlap) + 1).alias("st"),
            F.array_append(acc["e"], F.struct(acc["st"].alias("st"), u.alias("u"))).alias("e"))
        return F.when(fire, fired).otherwise(acc)

    def finish(acc: Column) -> Column:
        if not keep_tail:
            return acc["e"]
        last_u = F.coalesce(F.try_element_at(acc["e"], F.lit(-1))["u"], F.lit(0))   # no emit at all: the whole text
        tail = F.array(F.struct(acc["st"].alias("st"), n.alias("u")))
        return F.when(last_u < n, F.concat(acc["e"], tail)).otherwise(acc["e"])

    folded = F.aggregate(F.sequence(F.lit(1), n), init, step, finish)
    return F.when(s.isNotNull() & (n > 0), folded)


def closed_form_positions(s: Column, size: int = DEFAULT_SIZE) -> Column:
    """Emit positions (1-based) for overlap >= size; pass a column reference."""
    last = F.element_at(s, -1)

    def fires(u: Column) -> Column:
        x = F.element_at(s, u)
        return ((u == F.lit(size)) & ~is_decimal(x)) | (x.endswith(".") & (x == last))

    return F.when(s.isNotNull() & (F.size(s) > 0), F.filter(F.sequence(F.lit(1), F.size(s)), fires))


def spans_from_positions(e: Column, overlap: int) -> Column:
    """(st, u) spans from emit positions; pass a column reference to the positions."""
    def span(u: Column, i: Column) -> Column:
        prev = F.when(i == 0, F.lit(0)).otherwise(e[i - 1])
        return F.struct(F.greatest(F.lit(1), prev - F.lit(overlap) + 1).alias("st"), u.alias("u"))

    return F.transform(e, span)


def chunks_from_spans(s: Column, spans: Column) -> Column:
    return F.transform(
        spans, lambda sp: py_strip(F.array_join(F.slice(s, sp["st"], sp["u"] - sp["st"] + 1), " ")))


def chunk_sentences(s: Column, size: int = DEFAULT_SIZE, overlap: int = DEFAULT_OVERLAP,
                    keep_tail: bool = False) -> Column:
    """D3: array of chunk strings from a sentence-array column.

    Pass a column reference, not the split expression itself: the fold reads
    the array once per sentence, so an inline split would be re-run each time.
    """
    return chunks_from_spans(s, chunk_spans(s, size, overlap, keep_tail))


def chunk_records(records: DataFrame, size: int = DEFAULT_SIZE, overlap: int = DEFAULT_OVERLAP,
                  keep_tail: bool = False, order_col: str = "ord", url_col: str = "url",
                  text_col: str = "text") -> DataFrame:
    """One row per chunk: ``ord, chunk_no, url, data``.

    ``ord`` is the record's order key; ``(ord, chunk_no)`` is the chunk key.
    Records without chunks vanish; ``url`` may be null.
    """
    missing = {order_col, text_col} - set(records.columns)
    if missing:
        raise ValueError(f"records need columns {sorted(missing)}")
    url = F.col(url_col) if url_col in records.columns else F.lit(None).cast("string")
    split = records.select(F.col(order_col).alias("ord"), url.alias("url"),
                           split_sentences(F.col(text_col)).alias("_s"))
    if overlap >= size and not keep_tail:
        # each step reads the previous column by reference (never re-evaluates it)
        pos = split.select("ord", "url", "_s",
                           closed_form_positions(F.col("_s"), size).alias("_e"))
        spans = pos.select("ord", "url", "_s",
                           spans_from_positions(F.col("_e"), overlap).alias("_sp"))
    else:
        spans = split.select("ord", "url", "_s",
                             chunk_spans(F.col("_s"), size, overlap, keep_tail).alias("_sp"))
    chunks = spans.select("ord", "url",
                          chunks_from_spans(F.col("_s"), F.col("_sp")).alias("_chunks"))
    # posexplode_outer + filter: a plain posexplode makes the optimizer infer a
    # size(_chunks) > 0 filter below this projection, which re-runs the fold.
    return (chunks.select("ord", F.posexplode_outer("_chunks").alias("chunk_no", "data"), "url")
            .where(F.col("chunk_no").isNotNull())
            .select("ord", F.col("chunk_no").cast("bigint").alias("chunk_no"), "url", "data"))


def sentences(records: DataFrame, order_col: str = "ord", text_col: str = "text") -> DataFrame:
    """D2 as a table: ``ord, sentence_no, sentence``."""
    return records.select(
        F.col(order_col).alias("ord"),
        F.posexplode(split_sentences(F.col(text_col))).alias("sentence_no", "sentence"),
    ).select("ord", F.col("sentence_no").cast("bigint").alias("sentence_no"), "sentence")
