"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at most ``2r`` bits apart have a common point within ``r`` bits of
both. Every *distinct* fingerprint emits all points of its ball of radius ``r``;
equal points meet in a shuffle, colliding pairs are deduplicated and verified by
bit count. For ``r = 1`` (distance 2) that is 65 points, and a point is shared by at
most 65 fingerprints, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.bytesets import join_bytes, take_ranges, word_bounds
from corpusmill.llm.components import connected_components
from corpusmill.session import cut_lineage

_SLICE = 2000


def _fingerprints(texts: list[bytes], k: int) -> np.ndarray:
    """Fingerprint of each text: a bit is set where over half of its shingle hashes have it."""
    data, offs = join_bytes([t.lower() for t in texts])             # bytes.lower: A-Z only
    starts, ends, first = word_bounds(data, offs)
    count = np.diff(first)
    # words joined by one space, all texts in one buffer
    length = ends - starts + 1
    spaced = np.append(data, np.uint8(0x20))
    flat = take_ranges(spaced, starts, length)
    at = np.concatenate(([0], np.cumsum(length)))
    flat[at[1:] - 1] = 0x20
    buf = flat.tobytes()
    per = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    head = np.repeat(first[:-1], per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    last = head + np.repeat(np.minimum(count, k), per)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(buf[a:b], 42) for a, b in zip(at[head].tolist(), (at[last] - 1).tolist())),
                         np.uint64, len(head))
    out = np.zeros(len(texts), np.uint64)
    edge = np.concatenate(([0], np.cumsum(per)))
    step = 1 << 16
    for i in range(len(texts)):
        n = int(per[i])
        if n == 0:
            continue
        ones = np.zeros(64, np.int64)
        for lo in range(int(edge[i]), int(edge[i + 1]), step):      # bounded for very long texts
            part = hashes[lo:min(lo + step, int(edge[i + 1]))].astype(">u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > n).view(">u8")[0]
    return out


def fingerprints(docs: DataFrame, *, k: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 also: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, fp`` (64 bits as a signed long) and the long columns ``also`` per row; null and wordless texts have 0."""
    also = also or {}
    names = ["doc_id", "fp", *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            sizes = np.array([len(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()], np.int64)
            while at < batch.num_rows:                              # about 2 MB of text at a time
                take = int(np.searchsorted(np.cumsum(sizes[at:at + _SLICE]), 2 << 20)) + 1
                part = batch.slice(at, min(take, _SLICE))
                fps = _fingerprints([t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()], k)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64)), *part.columns[2:]],
                                                 names=names)
                at += part.num_rows

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       *[c.alias(name) for name, c in also.items()])
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _ball(radius: int) -> list[int]:
    points = {0}
    for _ in range(radius):
        points |= {p ^ (1 << b) for p in points for b in range(64)}
    return [p - (1 << 64) if p >= 1 << 63 else p for p in sorted(points)]


def near_links(prints: DataFrame, *, distance: int = 2) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints (column ``fp``) that connect every pair within ``distance`` bits.

    Exact for any distance 0-4: the ball radius is half of it, rounded up, and every
    colliding pair is verified, so odd distances only verify more.
    """
    if not 0 <= distance <= 4:
        raise ValueError("distance must be 0 to 4")
    if distance == 0:
        return prints.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    points = F.transform(F.lit(_ball((distance + 1) // 2)).cast("array<bigint>"), lambda m: m.bitwiseXOR(F.col("fp")))
    met = (prints.select("fp", F.explode(points).alias("point")).groupBy("point")
           .agg(F.collect_list("fp").alias("met")).where(F.size("met") > 1))       # at most one ball's size
    pairs = (met.select(F.explode("met").alias("u"), "met").select("u", F.explode("met").alias("v"))
             .where("u < v").distinct())
    return pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)


def near_groups(docs: DataFrame, *, k: int = 3, distance: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` for every row.

    Texts are lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and ``k``-word
    shingles, repeats included; XXH64 with seed 42. Fingerprints within ``distance``
    bits are linked, ``component_id`` is the smallest id reachable. Defined cases: a
    text of fewer than ``k`` words is one shingle; null and wordless texts have
    fingerprint zero and are linked like any other; repeated rows share a component;
    a null id gets its group's component (null if the whole group has none); an empty
    table gives an empty result; other columns are not read and not returned.
    """
    prints = fingerprints(docs, k=k, id_col=id_col, text_col=text_col)
    prints = cut_lineage(prints)                                     # 16 bytes a row; texts are hashed once
    kinds = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = _with_roots(kinds, distance)
    least = labels.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labels.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _with_roots(kinds: DataFrame, distance: int) -> DataFrame:
    roots = connected_components(near_links(kinds, distance=distance))
    return kinds.join(roots, kinds["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


#: Exact repeats of a kept row are looked up by broadcast up to this many kinds (32 bytes each).
_BROADCAST_REPEATS = 50_000


def keep_one(docs: DataFrame, *, k: int = 3, distance: int = 2, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Exactly one input row of each near-duplicate group, with all its columns.

    It is the row of the smallest id, null ids last, then of the least hash of the text and
    of the other columns. Rows are told apart by these three, so rows that repeat an id are
    judged one by one, and of rows that repeat all columns one stays.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    hashes = {"t": F.xxhash64(F.col(f"`{text_col}`").cast("string")),
              "r": F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in others]))) if others else F.lit(0).cast("long")}
    prints = cut_lineage(fingerprints(docs, k=k, id_col=id_col, text_col=text_col, also=hashes))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t", "r")
    kinds = cut_lineage(prints.groupBy("fp").agg(F.min(place).alias("least")))
    labels = _with_roots(kinds, distance)
    first = labels.groupBy("root").agg(F.min("least").alias("first"))
    first = labels.join(first, "root").select("fp", "first")
    rows = prints.groupBy("fp", "doc_id", "t", "r").count().join(first, "fp")
    marked = cut_lineage(rows.select("doc_id", "t", "r", (place == F.col("first")).alias("kept"), "count").where(
        "not kept or count > 1"))
    marked = marked.select(*[F.col(c).alias(f"_mark_{c}") for c in marked.columns])   # docs may have such columns
    mine = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("_mark_doc_id")) & (hashes["t"] == F.col("_mark_t")) & (
        hashes["r"] == F.col("_mark_r"))
    single = docs.join(marked, mine, "left_anti")
    repeated = marked.where("_mark_kept")
    many = repeated.count()
    if many == 0:
        return single
    repeated = docs.join(F.broadcast(repeated) if many <= _BROADCAST_REPEATS else repeated, mine)
    one = repeated.dropDuplicates(["_mark_doc_id", "_mark_t", "_mark_r"])            # equal in all columns
    return single.union(one.select(*[F.col(f"`{c}`") for c in docs.columns]))
