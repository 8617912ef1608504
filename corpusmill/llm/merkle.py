"""Merkle manifest of a dataset: one tree per part, one root over the parts' subroots.

Every node is labelled with the interval ``[lo, hi)`` of leaf ranks it covers, so the
parent of a node is the node one level up whose interval holds its own, and its
siblings are what is left of the parent's interval. Levels are handled in *bands*: a
bucket is a stretch of ``arity ** band_levels`` nodes of a band's lowest level, so all
ancestors within the band lie in the same bucket.

Up: each band's buckets are folded to one node each, until every part has one node,
its subroot; the subroots form one more tree. Down: the buckets of a band meet the
proof of their own top node (a join on part and bucket), and each node's proof is its
siblings in the band followed by that. A bucket holds a bounded number of nodes
whatever the size of a part; texts are hashed where they are read and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.rowindex import with_row_index
from corpusmill.session import cut_lineage

_NODE = "tree long, n long, idx long, hash binary"
_PATH = "tree long, idx long, proof string, subroot string, root string"
_OUT = ("doc_id long, part string, rank long, leaf string, subroot string, root string, proof string, "
        "proof_sha256 string, folded_root string, verified boolean")


def _hex(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def levels(n: int, arity: int) -> int:
    """Rounds until one node is left of ``n``."""
    count = 0
    while n > 1:
        n, count = -(-n // arity), count + 1
    return count


class Bucket:
    """Nodes of one bucket, level by level, as interval starts and ends and hashes."""

    def __init__(self, n: int, first: int, hashes: list[str], band: int, band_levels: int, arity: int):
        low = band * band_levels
        width = arity ** low
        lo = (first + np.arange(len(hashes), dtype=np.int64)) * width
        self.lo, self.hi, self.hash = [lo], [np.minimum(lo + width, n)], [hashes]
        for _ in range(min(band_levels, max(0, levels(n, arity) - low))):
            width *= arity
            lo, hi, below = self.lo[-1], self.hi[-1], self.hash[-1]
            new = np.unique(lo // width) * width
            cut = np.searchsorted(lo, np.append(new, new[-1] + width))     # children lie in their parent's interval
            self.hash.append([_hex("".join(below[a:b])) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())])
            self.lo.append(new)
            self.hi.append(np.minimum(new + width, n))

    def proofs(self) -> list[str]:
        """Siblings of each lowest node, level by level: ``left/right``, levels joined by ``;``."""
        at = np.arange(len(self.lo[0]))
        out: list[list[str]] = [[] for _ in at]
        for k in range(len(self.lo) - 1):
            lo, hi, names = self.lo[k], self.hi[k], self.hash[k]
            parent = np.searchsorted(self.lo[k + 1], lo, "right") - 1      # the interval that holds this one
            first = np.searchsorted(lo, self.lo[k + 1][parent])            # the parent's interval less the own one
            last = np.searchsorted(lo, self.hi[k + 1][parent])
            own = np.searchsorted(lo, hi)
            steps = ["".join(names[a:i]) + "/" + "".join(names[b:c])
                     for i, (a, b, c) in enumerate(zip(first.tolist(), own.tolist(), last.tolist()))]
            for path, i in zip(out, at.tolist()):
                path.append(steps[i])
            at = parent[at]
        return [";".join(path) for path in out]


def _joined(low: str, high: str) -> str:
    return low + ";" + high if low and high else low or high


def fold(leaf: str, proof: str) -> str:
    """The root that a leaf and its proof lead to."""
    for step in proof.split(";") if proof else ():
        left, right = step.split("/")
        leaf = _hex(left + leaf + right)
    return leaf


def proof_digest(proof: str) -> str:
    """H of the siblings alone, level by level, left to right."""
    return _hex(proof.replace(";", "").replace("/", ""))


def _hand_down(read: Callable[[pa.Table], Bucket], finish: Callable, schema: str) -> Callable:
    def run(nodes: pa.Table, upper: pa.Table) -> pa.Table:
        if nodes.num_rows == 0 or upper.num_rows == 0:
            return _empty(schema)
        nodes = nodes.sort_by("idx")
        up = upper.to_pylist()[0]
        return finish(nodes, [_joined(p, up["proof"]) for p in read(nodes).proofs()], up)

    return run


def _path_rows(nodes: pa.Table, proofs: list[str], up: dict) -> pa.Table:
    m = len(proofs)
    return pa.table({"tree": nodes["tree"], "idx": nodes["idx"], "proof": pa.array(proofs, pa.string()),
                     "subroot": pa.array([up["subroot"]] * m, pa.string()), "root": pa.array([up["root"]] * m, pa.string())})


class _Forest:
    """Bands of nodes over leaves ``tree, n, idx, hash``, and the join that hands proofs down."""

    def __init__(self, leaves: DataFrame, arity: int, band_levels: int):
        self.arity, self.band_levels = arity, band_levels
        self.bands = [leaves]
        most = leaves.agg(F.max("n")).first()[0] or 0
        for band in range(max(1, -(-levels(most, arity) // band_levels))):
            self.bands.append(cut_lineage(self._tops(band)))

    @property
    def tops(self) -> DataFrame:
        return self.bands[-1]

    def bucketed(self, band: int) -> DataFrame:
        return self.bands[band].withColumn("bucket", F.expr(f"idx div {self.arity ** self.band_levels}"))

    def reader(self, band: int) -> Callable[[pa.Table], Bucket]:
        band_levels, arity = self.band_levels, self.arity

        def read(table: pa.Table) -> Bucket:
            hashes = [h.hex() for h in table["hash"].to_pylist()]
            return Bucket(table["n"][0].as_py(), table["idx"][0].as_py(), hashes, band, band_levels, arity)

        return read

    def _tops(self, band: int) -> DataFrame:
        read = self.reader(band)

        def run(table: pa.Table) -> pa.Table:
            nodes = read(table.sort_by("idx"))
            return pa.table({"tree": table["tree"][:1], "n": table["n"][:1], "idx": table["bucket"][:1],
                             "hash": pa.array([bytes.fromhex(nodes.hash[-1][0])], pa.binary())})

        rows = self.bucketed(band).select("tree", "n", "idx", "hash", "bucket")
        return rows.groupBy("tree", "bucket").applyInArrow(run, _NODE)

    def proofs(self, tops: DataFrame, finish: Callable[[pa.Table, list[str], dict], pa.Table], schema: str) -> DataFrame:
        """Hand ``tops`` (a row of ``_PATH`` per tree) down; ``finish`` makes the rows of the lowest band."""
        paths = tops
        for band in range(len(self.bands) - 2, -1, -1):
            last = band == 0
            hand_down = _hand_down(self.reader(band), finish if last else _path_rows, schema if last else _PATH)
            paths = (self.bucketed(band).groupBy("tree", "bucket")
                     .cogroup(paths.withColumnRenamed("idx", "bucket").groupBy("tree", "bucket"))
                     .applyInArrow(hand_down, schema if last else _PATH))
        return paths


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _empty(schema: str) -> pa.Table:
    names = [c.split() for c in schema.split(", ")]
    return pa.table({name: pa.array([], _ARROW[kind]) for name, kind in names})


def _leaves(docs: DataFrame, fields: Sequence[str], part_col: str, id_col: str,
            changed: Mapping[str, Column]) -> DataFrame:
    """``tree, n, idx, hash, doc_id, part, altered``: leaves ranked by id within their part.

    A part's tree is named by the global rank of its first leaf, so trees are in part order.
    """
    leaf = leaf_hash([F.col(c) for c in fields])
    altered = leaf_hash([changed.get(c, F.col(c)) for c in fields])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(part_col).cast("string").alias("part"),
                       F.unhex(leaf).alias("hash"), (F.unhex(altered) if changed else F.lit(None).cast("binary")).alias("altered"))
    rows = rows.withColumn("altered", F.when(F.col("altered") != F.col("hash"), F.col("altered")))
    ranked = with_row_index(rows, ["part", "doc_id", "hash", "altered"], "_at")
    parts = ranked.groupBy(F.col("part").alias("_part")).agg(F.min("_at").alias("tree"), F.count(F.lit(1)).alias("n"))
    return ranked.join(parts, F.col("part").eqNullSafe(F.col("_part"))).select(
        "tree", "n", (F.col("_at") - F.col("tree")).alias("idx"), "hash", "doc_id", "part", "altered")


def manifest(docs: DataFrame, *, fields: Sequence[str], part_col: str, id_col: str = "doc_id",
             changed: Mapping[str, Column] | None = None, arity: int = 2, band_levels: int = 12) -> DataFrame:
    """Leaf, subroot, root and inclusion proof of every row, and whether a changed row still leads to the root.

    A leaf is the hash of ``fields`` (see ``field``). Per part, leaves ascend by id; while
    several nodes remain, each run of ``arity`` becomes the hash of its hex digests joined,
    a shorter last run too. Subroots in part order give the root likewise. ``changed``
    replaces columns by expressions: ``folded_root`` is the root recomputed from the
    changed leaf and the proof, ``verified`` whether it is the root.

    Returns ``doc_id, part, rank, leaf, subroot, root, proof, proof_sha256, folded_root,
    verified``; a proof is one ``left/right`` per level, levels joined by ``;``.
    Defined cases: null values hash as ``-``; null parts are one part, the first; null
    ids come first in their part; rows that repeat an id are ordered by their leaf's hash,
    so equal rows have proofs that differ but share leaf and root; a part of one row has
    its leaf as subroot and a single part's subroot is the root (proof: empty); empty
    texts are values of no bytes and long ones are hashed whole; an empty table gives an
    empty result; other columns of the input are not read and not returned.
    """
    leaves = cut_lineage(_leaves(docs, fields, part_col, id_col, changed or {}))
    forest = _Forest(leaves, arity, band_levels)
    tops = with_row_index(forest.tops.select("tree", "hash"), ["tree"], "idx", "n")
    roots = _Forest(tops.select(F.lit(0).cast("long").alias("tree"), "n", "idx", "hash",
                                F.col("tree").alias("part_tree")), arity, band_levels)

    def subroot_rows(nodes: pa.Table, proofs: list[str], up: dict) -> pa.Table:
        m = nodes.num_rows
        return pa.table({"tree": nodes["part_tree"], "idx": pa.array([0] * m, pa.int64()), "proof": pa.array(proofs, pa.string()),
                         "subroot": pa.array([h.hex() for h in nodes["hash"].to_pylist()], pa.string()),
                         "root": pa.array([up["root"]] * m, pa.string())})

    def leaf_rows(nodes: pa.Table, proofs: list[str], up: dict) -> pa.Table:
        m = nodes.num_rows
        own = [h.hex() for h in nodes["hash"].to_pylist()]
        tried = [o if a is None else a.hex() for o, a in zip(own, nodes["altered"].to_pylist())]
        folded = [fold(leaf, proof) for leaf, proof in zip(tried, proofs)]
        return pa.table({"doc_id": nodes["doc_id"], "part": nodes["part"], "rank": nodes["idx"], "leaf": pa.array(own, pa.string()),
                         "subroot": pa.array([up["subroot"]] * m, pa.string()), "root": pa.array([up["root"]] * m, pa.string()),
                         "proof": pa.array(proofs, pa.string()), "proof_sha256": pa.array(map(proof_digest, proofs), pa.string()),
                         "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == up["root"] for f in folded], pa.bool_())})

    start = roots.tops.select("tree", "idx", F.lit("").alias("proof"), F.lit(None).cast("string").alias("subroot"),
                              F.lower(F.hex("hash")).alias("root"))
    handed = cut_lineage(roots.proofs(start, subroot_rows, _PATH))
    return forest.proofs(handed, leaf_rows, _OUT)


def node_table(docs: DataFrame, *, fields: Sequence[str], part_col: str, id_col: str = "doc_id", arity: int = 2,
               band_levels: int = 12) -> DataFrame:
    """The manifest itself: every node of every part's tree as ``tree, level, lo, hi, hash``.

    ``tree`` is the global rank of the part's first leaf; cases are those of ``manifest``.
    """
    forest = _Forest(cut_lineage(_leaves(docs, fields, part_col, id_col, {})), arity, band_levels)
    out = None
    for band in range(len(forest.bands) - 1):
        rows = (forest.bucketed(band).select("tree", "n", "idx", "hash", "bucket").groupBy("tree", "bucket")
                .applyInArrow(_labelled(forest.reader(band), band, band_levels),
                              "tree long, level long, lo long, hi long, hash string"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _labelled(read: Callable[[pa.Table], Bucket], band: int, band_levels: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        nodes = read(table.sort_by("idx"))
        keep = range(1 if band else 0, len(nodes.lo))                # a band's lowest level is the top of the one below
        return pa.table({
            "tree": pa.array([table["tree"][0].as_py()] * sum(len(nodes.lo[k]) for k in keep), pa.int64()),
            "level": pa.array([band * band_levels + k for k in keep for _ in nodes.lo[k]], pa.int64()),
            "lo": pa.array(np.concatenate([nodes.lo[k] for k in keep] or [np.zeros(0, np.int64)])),
            "hi": pa.array(np.concatenate([nodes.hi[k] for k in keep] or [np.zeros(0, np.int64)])),
            "hash": pa.array([h for k in keep for h in nodes.hash[k]], pa.string())})

    return run
