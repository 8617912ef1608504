"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is a stream of words: its documents in a seeded order, laid end to end,
cut into blocks of ``block_words``. A source's target is a quota of block draws; a
block can be drawn at most ``repeats`` times. The root of the tree holds all quotas;
every node splits them between its two halves of the output shards by one
multivariate-hypergeometric draw, so each shard has an exact quota of every source
and the total is exact at every level. A shard then draws its quota as consecutive
ranks of a seeded permutation of the source's blocks: ranges are disjoint, so no two
shards share a draw. Rows of a shard get a seeded local order.

The driver sees one row per source (words and weight). Documents never leave Spark;
their positions in the stream come from sums over about sqrt(n) buckets per source,
so no task holds a whole source.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.llm.bytesets import column_bytes, mix, word_bounds
from corpusmill.session import cut_lineage

#: Blocks that a source has at least; small sources get smaller blocks, so their quota is as exact.
LEAST_BLOCKS = 256
_TURNS = [np.uint64(r * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for r in range(6)]


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Share ``total`` by weight; a target stops at ``most`` times its size and its excess is shared again."""
    out = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = float(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def split_quotas(quotas: np.ndarray, shards: int, lo: int, hi: int, seed: int) -> list[tuple]:
    """Quotas (shard x source) and ranks before them for shards ``lo`` to ``hi`` of the tree over ``shards``.

    Node seeds depend on the node alone, so any task can expand its own part.
    """
    out = []

    def walk(first: int, count: int, have: np.ndarray, before: np.ndarray) -> None:
        if first >= hi or first + count <= lo:
            return
        if count == 1:
            out.append((first, have, before))
            return
        half = (count + 1) // 2
        total = int(have.sum())
        take = total * half // count
        rng = np.random.default_rng([seed, first, count])
        # the marginals method draws one source after the other: linear in the sources at any count
        left = _hypergeometric(have, take, rng)
        walk(first, half, left, before)
        walk(first + half, count - half, have - left, before + left)

    walk(0, shards, quotas.astype(np.int64), np.zeros(len(quotas), np.int64))
    return out


#: numpy's sampler takes populations below this.
_SAMPLER_LIMIT = 1_000_000_000


def _hypergeometric(have: np.ndarray, take: int, rng: np.random.Generator) -> np.ndarray:
    out, rest = np.zeros(len(have), np.int64), int(have.sum())
    for i, n in enumerate(have.tolist()):
        rest -= n
        if n and take:
            if not rest:
                x = take
            elif n + rest < _SAMPLER_LIMIT:
                x = int(rng.hypergeometric(n, rest, take))
            else:
                x = _inverted(n, rest, take, float(rng.random()))
            out[i] = x
            take -= x
    return out


def _inverted(n: int, rest: int, take: int, u: float) -> int:
    """Hypergeometric draw of any size by inverting the distribution function at ``u``.

    Weights come from the ratios of neighbouring probabilities, over all values within 13
    standard deviations of the mean: what lies beyond is less than a double resolves.
    """
    whole = n + rest
    mean = take * n / whole
    spread = math.sqrt(mean * (rest / whole) * (whole - take) / max(1, whole - 1))
    low, high = max(0, take - rest), min(n, take)
    lo = max(low, math.floor(mean - 13 * spread) - 30)
    hi = min(high, math.ceil(mean + 13 * spread) + 30)
    x = np.arange(lo, hi, dtype=np.float64)                          # exact: below 2 ** 53
    ratio = np.log(n - x) + np.log(take - x) - np.log(x + 1) - np.log(rest - take + x + 1)
    log = np.concatenate(([0.0], np.cumsum(ratio)))
    weight = np.cumsum(np.exp(log - log.max()))
    return min(hi, lo + int(np.searchsorted(weight, u * weight[-1], side="right")))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Rank of each index in a seeded permutation of [0, n): a Feistel network, walked until it lands inside."""
    bits = np.maximum(2, np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64))
    half = ((bits + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo]
        left, right = x >> h, x & m
        for turn in _TURNS:
            left, right = right, left ^ (mix(right + k + turn) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _tie(id_col, text_col):
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.lit(1))


def with_sizes(docs: DataFrame, *, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``doc_id, source, size, tie``: words ``[^\\x20\\x09-\\x0D]+`` of each text, counted on its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sizes = np.diff(word_bounds(*column_bytes(part.column(2)))[2]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes), part.column(3)],
                                                 names=["doc_id", "source", "size", "tie"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.select("*", _tie("doc_id", "text").alias("tie")).mapInArrow(
        run, "doc_id long, source string, size long, tie long")


def source_table(sized: DataFrame, weights: Sequence[float], share: float, repeats: int) -> list[dict]:
    """One row per source by code point, null last: number, words, documents and target."""
    rows = [r.asDict() for r in sized.groupBy("source").agg(F.sum("size").alias("words"),
                                                           F.count("*").alias("docs")).collect()]
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    goal = targets([r["words"] for r in rows], [weights[i % len(weights)] for i in range(len(rows))],
                   share * sum(r["words"] for r in rows), repeats)
    for i, (r, t) in enumerate(zip(rows, goal)):
        r.update(number=i, target=t)
    return rows


def positions(sized: DataFrame, sources: list[dict], seed: int) -> DataFrame:
    """Add ``number`` and ``start``, the words of the source's stream before each document."""
    spark = sized.sparkSession
    table = spark.createDataFrame([(r["source"], r["number"], max(1, math.isqrt(r["docs"]))) for r in sources],
                                  "source string, number int, buckets long")
    keyed = sized.join(F.broadcast(table.withColumnRenamed("source", "_source")),   # a row per source
                       F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    keyed = keyed.withColumn("order", F.xxhash64("doc_id", "tie", F.lit(seed))).withColumn(
        "bucket", F.pmod(F.col("order"), F.col("buckets")))
    sums = keyed.groupBy("number", "bucket").agg(F.sum("size").alias("_words"))
    before = sums.select("number", "bucket", (F.sum("_words").over(
        W.partitionBy("number").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))).alias("_before"))
    inside = F.sum("size").over(W.partitionBy("number", "bucket").orderBy("order", "doc_id", "tie").rowsBetween(
        W.unboundedPreceding, -1))
    return keyed.withColumn("_inside", inside).join(before, ["number", "bucket"]).select(
        "doc_id", "tie", "source", "size", "number",
        (F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0))).alias("start"))


def draw(placed: DataFrame, sources: list[dict], *, block_words: int, shard_words: int, repeats: int,
         seed: int) -> DataFrame:
    """The mix: rows ``shard, place, source, number, doc_start, doc_id, copy, start, n_words`` of drawn words."""
    spark = placed.sparkSession
    width = np.array([min(block_words, max(1, r["words"] // LEAST_BLOCKS)) for r in sources], np.int64)
    blocks = np.array([-(-r["words"] // int(w)) for r, w in zip(sources, width)], np.int64)
    quotas = np.minimum(np.array([round(r["target"] / int(w)) for r, w in zip(sources, width)], np.int64), repeats * blocks)
    shards = max(1, math.ceil(int((quotas * width).sum()) / shard_words))
    bin_ = max(1, shard_words // block_words // 16)                  # ranks per join bin
    keys = mix(np.arange(len(sources), dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [] if not ids else [
                (shard, j, int(b), int(b + q), k)
                for shard, have, before in split_quotas(quotas, shards, min(ids), max(ids) + 1, seed)
                for j, (q, b) in enumerate(zip(have.tolist(), before.tolist())) if q
                for k in range(b // bin_, (b + q - 1) // bin_ + 1)]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["shard", "number", "lo", "hi", "bin"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                doc, src, size, num, start, tie = (part.column(c) for c in range(6))
                size, num, start = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (size, num, start))
                live = np.flatnonzero((size > 0) & (quotas[num] > 0))
                w = width[num]
                first, last = start[live] // w[live], (start[live] + size[live] - 1) // w[live]
                row = np.repeat(live, last - first + 1)
                block = np.repeat(first, last - first + 1) + _ramp(last - first + 1)
                a = np.maximum(start[row], block * w[row])
                b = np.minimum(start[row] + size[row], (block + 1) * w[row])
                for copy in range(repeats):
                    n = blocks[num[row]]
                    rank = copy * n + permuted(block, n, keys[num[row]] + np.uint64(copy))
                    use = np.flatnonzero(rank < quotas[num[row]])
                    r = row[use]
                    yield pa.RecordBatch.from_arrays(
                        [doc.take(pa.array(r)), src.take(pa.array(r)), pa.array(num[r]), pa.array(rank[use]),
                         pa.array(rank[use] // bin_), pa.array(np.full(len(use), copy, np.int32)),
                         pa.array(start[r]), pa.array(a[use] - start[r]), pa.array(b[use] - a[use]),
                         tie.take(pa.array(r))],
                        names=["doc_id", "source", "number", "rank", "bin", "copy", "doc_start", "start", "n_words", "tie"])

    tree = spark.range(shards).mapInArrow(expand, "shard long, number long, lo long, hi long, bin long")
    spans = placed.select("doc_id", "source", "size", F.col("number").cast("long"), "start", "tie").mapInArrow(
        cut, "doc_id long, source string, number long, rank long, bin long, copy int, doc_start long, start long, "
             "n_words long, tie long")
    drawn = spans.join(tree, ["number", "bin"]).where("rank >= lo and rank < hi")
    return drawn.select("shard", F.xxhash64("shard", "number", "rank", F.lit(seed)).alias("place"), "source",
                        "number", "doc_start", "doc_id", "tie", "copy", "start", "n_words")


def _ramp(counts: np.ndarray) -> np.ndarray:
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def mix_sources(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: int = 2,
                block_words: int = 64, shard_words: int = 1 << 20, seed: int = 20, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Draw a mix of ``share`` times all words; returns (documents, draws).

    ``documents`` has every input row: ``doc_id, source, size, source_size, target,
    number, start``. ``draws`` has the mix: ``shard``, ``place`` (order within the shard;
    rows of one block share it and follow by copy, doc_start and start), ``source, number``
    and ``doc_start`` (together the row that is drawn), ``doc_id, copy, start, n_words``
    (a stretch of the document's words). Sources go by code
    point, null last, and weights repeat over them. A source's draws are within one
    block of its target, and no document is drawn over ``repeats`` times its size.
    Reruns agree. Defined cases: null and wordless texts have size 0 and are never
    drawn; repeated rows are drawn each; a null id stays null; an empty table gives two
    empty results; other columns are not read and not returned.
    """
    sized = cut_lineage(with_sizes(docs, id_col=id_col, text_col=text_col, source_col=source_col))
    sources = source_table(sized, weights, share, repeats)
    spark = docs.sparkSession
    placed = cut_lineage(positions(sized, sources, seed))            # 40 bytes a document, no text
    totals = spark.createDataFrame([(r["number"], r["words"], float(r["target"])) for r in sources],
                                   "number int, source_size long, target double")
    documents = placed.join(F.broadcast(totals), "number").select(   # a row per source
        "doc_id", "source", "size", "source_size", "target", "number", "start")
    return documents, draw(placed, sources, block_words=block_words, shard_words=shard_words, repeats=repeats, seed=seed)


def taken(documents: DataFrame, draws: DataFrame) -> DataFrame:
    """``documents`` with ``taken``: the words that the mix takes of each row, repeats counted."""
    sums = draws.groupBy("number", F.col("doc_start").alias("start")).agg(F.sum("n_words").alias("_taken"))
    # rows without words share the start of the row behind them and are never drawn
    return documents.join(sums, ["number", "start"], "left").select(
        "doc_id", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce("_taken", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **options) -> DataFrame:
    """The mix as documents: one row per drawn document and copy, with the columns of ``docs``.

    A copy drawn whole keeps its text; otherwise its stretches, each as it stands in the
    text, are joined by line breaks in their order. Rows that repeat id and text count
    as one document here (sources still weigh every row).
    """
    unique = docs.withColumn("_tie", _tie(id_col, text_col)).repartition(id_col, "_tie").dropDuplicates([id_col, "_tie"])
    _, draws = mix_sources(unique.drop("_tie"), id_col=id_col, text_col=text_col, source_col=source_col, **options)
    spans = draws.groupBy("doc_id", "tie").agg(
        F.sort_array(F.collect_list(F.struct("copy", "start", "n_words"))).alias("_spans"))   # a document's own blocks
    rows = unique.join(spans, (F.col("_tie") == F.col("tie")) & unique[id_col].cast("long").eqNullSafe(spans["doc_id"]))
    rows = rows.select(*[unique[c] for c in docs.columns], "_spans")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                data, offs = column_bytes(part.column(at))
                starts, ends, first = word_bounds(data, offs)
                row, texts = [], []
                for i, spans in enumerate(part.column(part.num_columns - 1).to_pylist()):
                    a, z = int(first[i]), int(first[i + 1])
                    copies: dict[int, list[list[int]]] = {}
                    for s in spans:
                        own = copies.setdefault(s["copy"], [])
                        if own and own[-1][1] == s["start"]:
                            own[-1][1] += s["n_words"]
                        else:
                            own.append([s["start"], s["start"] + s["n_words"]])
                    for own in copies.values():
                        row.append(i)
                        if own == [[0, z - a]]:
                            texts.append(data[offs[i]:offs[i + 1]].tobytes())
                        else:
                            texts.append(b"\n".join(data[starts[a + x]:ends[a + y - 1]].tobytes() for x, y in own))
                out = part.take(pa.array(row, pa.int64()))
                cols = [pa.array(texts, pa.binary()).cast(pa.string()) if c == at else out.column(c)
                        for c in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(cols, names=part.schema.names[:-1])

    schema = docs.select(*[F.col(c).cast("string") if c == text_col else F.col(c) for c in docs.columns]).toDF(*docs.columns).schema
    return rows.mapInArrow(run, schema)
