"""Exact top-k inner-product search over an impact-ordered, score-at-a-time index.

Vectors are integers. Every block of candidates is indexed by posting segments: for
each dimension and sign, the candidates whose shifted component has bit ``p`` set, a
segment of impact ``2^p``. Shifts make all impacts non-negative (``v - low`` serves
positive query weights, ``high - v`` negative ones), so partial scores only grow.

A block of queries runs through a candidate block's segments by descending impact.
After each level a candidate's score is known to within ``sum|q| * (2^p - 1)``. One
below the k-th best partial score even with all of that can't be a member. Processing
stops only when this proof leaves few possible members (or all segments are done),
and those are rescored exactly from their vectors. Segments are bitmaps, because
dense vectors set about half of the bits; a level of all of them is one product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.llm.exchange import open_blob, pack_blob
from corpusmill.session import cut_lineage

_INDEX = [np.int64, np.int64, np.int64, np.int64, np.uint8, np.int64]   # ids, rows, low, high, segments, vectors
_QUERY = [np.int64, np.int64, np.int64]                                  # ids, rows, vectors
_RESCORE = 100_000
OUT = "query_id long, query_row long, vec_id long, score long"


def quantised(vectors: DataFrame, is_query: Column, *, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, row, asked, dim, v`` with ``floor(scale * x)`` as 64-bit integers; vectors with null or non-finite parts go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                ids, rows, asked, dims, out = [], [], [], [], []
                for i, r, a, x in zip(*(part.column(c).to_pylist() for c in (0, 2, 3)), part.column(1)):
                    values = x.values
                    if values is None or i is None or values.null_count:
                        continue
                    wide = values.to_numpy(zero_copy_only=False).astype(np.float64)
                    if np.isfinite(wide).all():
                        ids.append(i)
                        rows.append(r)
                        asked.append(a)
                        dims.append(len(wide))
                        out.append(np.floor(scale * wide).astype(np.int64).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(asked, pa.bool_()),
                     pa.array(dims, pa.int32()), pa.array(out, pa.binary())], names=["vec_id", "row", "asked", "dim", "v"])

    raw = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"),
                         F.monotonically_increasing_id().alias("row"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    return raw.mapInArrow(run, "vec_id long, row long, asked boolean, dim int, v binary")


def _matrix(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["v"].to_pylist()), np.int64).reshape(table.num_rows, -1)


def _index(table: pa.Table) -> pa.Table:
    x = _matrix(table)
    low, high = x.min(0), x.max(0)
    shifted = np.concatenate((x - low, high - x), axis=1)
    levels = max(1, int(shifted.max()).bit_length()) if shifted.size else 1
    segments = np.packbits(np.stack([(shifted >> p & 1).astype(np.uint8) for p in range(levels - 1, -1, -1)]), axis=2)
    blob = pack_blob([np.array(table["vec_id"]), np.array(table["row"]), low, high, segments, x])
    return pa.table({"dim": table["dim"].slice(0, 1), "b": table["b"].slice(0, 1), "z": pa.array([blob], pa.binary())})


def _pack_queries(table: pa.Table) -> pa.Table:
    blob = pack_blob([np.array(table["vec_id"]), np.array(table["row"]), _matrix(table)])
    return pa.table({"dim": table["dim"].slice(0, 1), "qb": table["qb"].slice(0, 1), "z": pa.array([blob], pa.binary())})


def search_block(queries: list[np.ndarray], index: list[np.ndarray], dim: int, k: int):
    """Top ``k`` of one candidate block for each query: arrays of query position, candidate position and score."""
    _, qrow, qv = queries
    cid, crow, low, high, segments, cv = index
    q, x, n = qv.reshape(-1, dim), cv.reshape(-1, dim), len(cid)
    weight = np.concatenate((np.maximum(q, 0), np.maximum(-q, 0)), axis=1)
    span = np.concatenate((high - low, high - low))
    bound = int((weight * span).sum(1).max()) if q.size else 0
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    levels = len(segments) // max(1, n * -(-2 * dim // 8))
    segments = segments.reshape(levels, n, -1)
    total = weight.sum(1)
    acc = np.zeros((len(q), n), kind)
    own = qrow[:, None] == crow[None, :] if np.intersect1d(qrow, crow).size else None
    few = 4 * k * len(q)
    alive = None
    for i in range(levels):
        p = levels - 1 - i
        bits = np.unpackbits(segments[i], axis=1, count=2 * dim).astype(kind)
        acc += (weight.astype(kind) @ bits.T) * kind(1 << p)
        if own is not None:
            acc[own] = -1                                            # a query's own row is no candidate
        if n <= k:
            continue
        rest = (total * ((1 << p) - 1)).astype(kind)
        least = np.partition(acc, n - k, axis=1)[:, n - k]           # k-th best partial score: all grow from here
        alive = acc + rest[:, None] >= least[:, None]
        if own is not None:
            alive[own] = False
        if p == 0 or int(alive.sum()) <= few:
            break
    if alive is None:
        alive = np.ones(acc.shape, bool) if own is None else ~own
    qi, ci = np.nonzero(alive)
    score = np.empty(len(qi), np.int64)
    for lo in range(0, len(qi), _RESCORE):                           # exact, from the vectors
        a, b = qi[lo:lo + _RESCORE], ci[lo:lo + _RESCORE]
        score[lo:lo + _RESCORE] = (q[a] * x[b]).sum(1)
    order = np.lexsort((crow[ci], cid[ci], -score, qi))
    qi, ci, score = qi[order], ci[order], score[order]
    first = np.searchsorted(qi, np.arange(len(q)))
    keep = np.arange(len(qi)) - first[qi] < k
    return qi[keep], ci[keep], score[keep]


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 20, scale: int = 64, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = 4096, query_rows: int = 1024) -> DataFrame:
    """The ``k`` highest integer inner products of every row where ``is_query`` holds, against every other row.

    Components become ``floor(scale * x)``. Returns ``query_id, rank`` (from 1), ``vec_id,
    score``, ties to the smaller ``vec_id``. Every row is indexed. Defined cases: a vector
    that is null or holds a null or non-finite part takes no part, nor does a null id;
    vectors meet only those of their own length; rows that repeat an id are rows of
    their own (a repeated query row is answered each time and finds its copy); an empty
    table gives an empty result; other columns are not read.
    """
    rows = cut_lineage(quantised(vectors, is_query, scale=scale, id_col=id_col, vector_col=vector_col))
    queries = rows.where("asked")
    n, nq = rows.count(), queries.count()
    blocks, query_blocks = max(1, math.ceil(n / block_rows)), max(1, math.ceil(nq / query_rows))
    index = (rows.withColumn("b", F.expr(f"cast(pmod(xxhash64(row), {blocks}) as int)"))
             .groupBy("dim", "b").applyInArrow(_index, "dim int, b int, z binary"))
    packed = (queries.withColumn("qb", F.expr(f"cast(pmod(xxhash64(row), {query_blocks}) as int)"))
              .groupBy("dim", "qb").applyInArrow(_pack_queries, "dim int, qb int, z binary"))
    index = cut_lineage(index)
    # every query block meets every candidate block: one row each per pair of blocks
    left = packed.select("dim", "qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), F.lit(0).alias("kind"), "z")
    right = index.select("dim", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), "b",
                         F.lit(1).alias("kind"), "z")

    def meet(table: pa.Table) -> pa.Table:
        dim, parts = table["dim"][0].as_py(), {s: z for s, z in zip(table["kind"].to_pylist(), table["z"].to_pylist())}
        if len(parts) < 2:
            e = pa.array([], pa.int64())
            return pa.table([e] * 4, names=["query_id", "query_row", "vec_id", "score"])
        q, x = open_blob(parts[0], _QUERY), open_blob(parts[1], _INDEX)
        qi, ci, score = search_block(q, x, dim, k)
        return pa.table({"query_id": q[0][qi], "query_row": q[1][qi], "vec_id": x[0][ci], "score": score})

    found = left.unionByName(right).groupBy("dim", "qb", "b").applyInArrow(meet, OUT)
    best = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
