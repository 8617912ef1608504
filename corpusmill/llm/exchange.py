"""Grouped exchange shared by the substring operators (super-k-mers, suffix runs).

Documents are hashed into *groups* of a bounded number of text bytes; a group is
the unit a Python worker holds. A group scatters its pieces to *buckets* as one
compressed blob per (group, bucket), a bucket answers with one blob per group,
and the answers meet the group's documents again in a co-grouped pass. All passes
read the documents through the same exchange (Spark reuses it inside one plan),
texts cross it compressed, and no pass holds more than one group or bucket.

Row identity inside a group is the position in (doc_id, text) order, so repeated
rows, repeated ids and null ids need no key of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.bytesets import covered, join_bytes, runs_of

#: Bytes of text that one group, and of pieces that one bucket, holds by default.
GROUP_BYTES = 4 << 20
#: Pieces hold every byte about three times; time is cheaper than shuffle files.
_LEVEL = 6
_BLOB = "bucket int, g int, kind int, z binary"
_ANSWER = "g int, z binary"


@dataclass(frozen=True)
class Groups:
    docs: DataFrame          # g, doc_id, z (compressed text), exchanged by g
    count: int               # groups, and buckets
    partitions: int


def group_documents(docs: DataFrame, id_col: str, text_col: str, group_bytes: int) -> Groups:
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = max(2 * parts, math.ceil(size / group_bytes), 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=_LEVEL, write_checksum=False)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(2).cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([press.compress(t or b"") for t in texts], pa.binary())],
                    names=["g", "doc_id", "z"])

    keyed = rows.select(F.expr(f"cast(pmod(xxhash64(doc_id, text), {count}) as int)").alias("g"), "doc_id", "text")
    packed = keyed.mapInArrow(pack, "g int, doc_id long, z binary").repartition(parts, "g")
    return Groups(packed, count, parts)


class GroupText:
    """The documents of one group in a fixed order: ids, which ids are null, bytes and offsets."""

    def __init__(self, table: pa.Table):
        ids = table["doc_id"].to_pylist()
        open_ = zstandard.ZstdDecompressor()
        texts = [open_.decompress(z) for z in table["z"].to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.ids = [ids[i] for i in order]
        self.known = np.array([i is not None for i in self.ids], bool)
        self.id = np.array([0 if i is None else i for i in self.ids], np.int64)
        self.texts = [texts[i] for i in order]
        self.data, self.offs = join_bytes(self.texts)


def pack_blob(arrays: list[np.ndarray]) -> bytes:
    head = np.array([len(arrays)] + [a.nbytes for a in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=_LEVEL, write_checksum=False).compress(head + b"".join(a.tobytes() for a in arrays))


def open_blob(z: bytes, dtypes: list) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(z)
    k = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, k, 8)
    out, at = [], 8 * (k + 1)
    for size, dtype in zip(sizes.tolist(), dtypes):
        out.append(np.frombuffer(raw, dtype, size // np.dtype(dtype).itemsize, at))
        at += size
    return out


PIECES, RUNS = 0, 1
_RUN_TYPES = [np.uint32] * 4                      # start and end; their high halves only where needed


def blob_table(buckets: list[int], g: int, blobs: list[bytes], kinds: list[int]) -> pa.Table:
    n = len(blobs)
    return pa.table({"bucket": pa.array(buckets, pa.int32()), "g": pa.array([g] * n, pa.int32()),
                     "kind": pa.array(kinds, pa.int32()), "z": pa.array(blobs, pa.binary())})


def run_blob(start: np.ndarray, end: np.ndarray) -> bytes:
    """Removed ranges of one group, counted over the group's units (words or bytes)."""
    wide = [start >> 32, end >> 32] if len(end) and end.max() >> 32 else []
    return pack_blob([x.astype(np.uint32) for x in (start, end, *wide)])


def open_runs(z: bytes) -> list[np.ndarray]:
    start, end, *wide = (x.astype(np.int64) for x in open_blob(z, _RUN_TYPES))
    return [start + (wide[0] << 32), end + (wide[1] << 32)] if wide else [start, end]


def remove_covered(groups: Groups, scatter: Callable, settle: Callable, finish: Callable, out_schema: str) -> DataFrame:
    """``scatter(group text, n buckets)`` gives (bucket, blob) pieces and the ranges settled inside the group;
    ``settle(blobs, their groups)`` gives (number of the blob, start, end) arrays of a bucket;
    ``finish(group text, start, end)`` gives the result columns of a group."""
    count, parts = groups.count, groups.partitions

    def scatter_group(table: pa.Table) -> pa.Table:
        g = table["g"][0].as_py()
        buckets, blobs, done = scatter(GroupText(table), count)
        kinds = [PIECES] * len(blobs)
        if len(done[0]):
            buckets, blobs, kinds = buckets + [g % count], blobs + [run_blob(*done)], kinds + [RUNS]
        return blob_table(buckets, g, blobs, kinds)

    def settle_bucket(table: pa.Table) -> pa.Table:
        gs, kinds, zs = table["g"].to_pylist(), table["kind"].to_pylist(), table["z"].to_pylist()
        out_g = [g for g, k in zip(gs, kinds) if k == RUNS]
        out_z = [z for z, k in zip(zs, kinds) if k == RUNS]
        pieces = sorted((g, z) for g, k, z in zip(gs, kinds, zs) if k == PIECES)
        if len(pieces) > 0:
            src, start, end = settle([z for _, z in pieces])
            order = np.argsort(src, kind="stable")
            src, start, end = src[order], start[order], end[order]
            cuts = np.flatnonzero(np.diff(src)) + 1
            lo = np.concatenate(([0], cuts)) if len(src) else []
            hi = np.concatenate((cuts, [len(src)])) if len(src) else []
            for a, b in zip(lo, hi):
                out_g.append(pieces[src[a]][0])
                out_z.append(run_blob(start[a:b], end[a:b]))
        return pa.table({"g": pa.array(out_g, pa.int32()), "z": pa.array(out_z, pa.binary())})

    def finish_group(docs: pa.Table, answers: pa.Table) -> pa.Table:
        text = GroupText(docs)
        runs = [open_runs(z) for z in answers["z"].to_pylist()]
        start, end = (np.concatenate([r[k] for r in runs]) if runs else np.zeros(0, np.int64)
                      for k in range(2))
        return finish(text, start, end)

    blobs = groups.docs.groupBy("g").applyInArrow(scatter_group, _BLOB).repartition(parts, "bucket")
    answers = blobs.groupBy("bucket").applyInArrow(settle_bucket, _ANSWER)
    return groups.docs.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(finish_group, out_schema)


def settled_runs(n: int, offs: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Merge ranges over the group's units into few; runs stop at document borders."""
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return runs_of(covered(n, starts, ends), offs)
