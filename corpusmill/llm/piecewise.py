"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last few bytes triggers chunk borders where it hits the
block size, so an edit disturbs only the chunks it touches. A fingerprint is
``block:signature:signature`` with one 12-bit symbol (two base64 characters) per
chunk, for a block size and its double. The block size is the least of ``4 * 2^i``
that should give at most 64 chunks. Fingerprints compare at block sizes they share,
by edit distance over symbols (insertions and deletions), scaled to 0-1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.bytesets import mix, range_hash

_WINDOW = 6
_LEAST = 4
_CHUNKS = 64
_BASE = 0x9E3779B97F4A7C15
# fixed values: the base64 alphabet of RFC 4648
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_SYMBOL = [a + b for a in _ALPHABET for b in _ALPHABET]
_STEP = 1 << 20

PAIRS = ("doc_id long, next_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double")


def block_size(n: int) -> int:
    size = _LEAST
    while size * _CHUNKS < n:
        size *= 2
    return size


def fingerprint(text: bytes) -> str:
    """Fingerprint of UTF-8 bytes; the empty text has no chunks. Long texts are rolled in stretches, whole."""
    n, size = len(text), block_size(len(text))
    if n == 0:
        return f"{size}::"
    data = np.frombuffer(text, np.uint8)
    coded = mix(data.astype(np.uint64) + np.uint64(1))
    fine, coarse = [], []
    for lo in range(0, n, _STEP):                                    # a border depends on _WINDOW bytes alone
        a, b = max(0, lo - _WINDOW + 1), min(n, lo + _STEP)
        part = coded[a:b]
        if len(part) < _WINDOW:
            continue
        roll = part[:len(part) - _WINDOW + 1].copy()
        for j in range(1, _WINDOW):
            roll = (roll << np.uint64(7) | roll >> np.uint64(57)) + part[j:len(part) - _WINDOW + 1 + j]
        roll = mix(roll)
        ends = np.arange(a + _WINDOW, b + 1)
        fine.append(ends[(roll & np.uint64(size - 1)) == 0])
        coarse.append(ends[(roll & np.uint64(2 * size - 1)) == 0])
    return ":".join([str(size), *(_signature(coded, np.concatenate(c) if c else np.zeros(0, np.int64), n)
                                  for c in (fine, coarse))])


def _signature(coded: np.ndarray, borders: np.ndarray, n: int) -> str:
    edges = np.unique(np.concatenate(([0], borders, [n]))).astype(np.int64)
    codes = range_hash(coded, edges[:-1], edges[1:], _BASE) >> np.uint64(52)
    return "".join(map(_SYMBOL.__getitem__, codes.tolist()))


def _common_length(a: list[str], b: list[str]) -> int:
    """Longest common subsequence, one machine-word-like integer row per symbol of ``b`` (bit-parallel)."""
    where: dict[str, int] = {}
    for i, s in enumerate(a):
        where[s] = where.get(s, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for s in b:
        hit = row & where.get(s, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    x, y = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in (a, b))
    if not x or not y:
        return 0.0
    # insert/delete distance is len(x) + len(y) - 2 * common; 1 minus its share of the longest possible one
    return 2 * _common_length(x, y) / (len(x) + len(y))


def likeness(a: str, b: str) -> float:
    """0 to 1: the best over block sizes that both fingerprints carry; 0 if there is none."""
    if a == b:
        return 1.0
    na, a1, a2 = a.split(":")
    nb, b1, b2 = b.split(":")
    na, nb = int(na), int(nb)
    if na == nb:
        return max(_alike(a1, b1), _alike(a2, b2) if a2 or b2 else 0.0)
    if na == 2 * nb:
        return _alike(a1, b2)
    if nb == 2 * na:
        return _alike(a2, b1)
    return 0.0


def edit(text: str, other: str) -> str:
    """The last half of ``text`` replaced by as many first code points of ``other`` (or all)."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row's whole text; null is empty, equal texts have equal fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([fingerprint(t or b"") for t in texts])],
                                                 names=["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string")


def _greatest(rows: DataFrame, cuts: list[int]) -> list[int]:
    """The greatest value of each range that the falling cuts make, without ranges that hold none."""
    rising = np.array(cuts[::-1], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            own = np.searchsorted(rising, values)
            order = np.lexsort((values, own))
            last = np.flatnonzero(np.append(own[order][1:] != own[order][:-1], True)) if len(order) else order
            yield pa.RecordBatch.from_arrays([pa.array(own[order][last].astype(np.int32)), pa.array(values[order][last])],
                                             names=["k", "value"])

    kept = rows.select("value").mapInArrow(run, "k int, value long").groupBy("k").agg(F.max("value").alias("value")).collect()
    return sorted((r["value"] for r in kept), reverse=True)


def compare_with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      ranges: int | None = None) -> DataFrame:
    """Fingerprint each text, its edited text, and the next document by descending id (after the last: the first).

    Returns one row per input row: ``doc_id, next_id, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited, near_next``. Ids are cut into ranges at real ids (the
    driver holds one id per range), rows without an id at hashes of their texts. A row goes to
    its range; the first row of a range goes to the range above as well (one a batch of
    rows at most), so every row finds its successor without a
    single-partition window and texts are exchanged once. Defined cases: null texts are
    empty; rows that repeat an id follow each other by text; null ids come last, by
    descending hash of the text, then by text;
    a table of one row is its own next; an empty table gives an empty result; other
    columns are not read and not returned.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * parts
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    points = [i / ranges for i in range(1, ranges + 1)]
    # 52 bits of the hash: percentiles are computed in doubles
    rows = rows.select("doc_id", F.coalesce("doc_id", F.shiftright(F.xxhash64("text"), 12)).alias("value"), "text")
    known, none = F.col("doc_id").isNotNull(), F.col("doc_id").isNull()

    def cuts(which) -> list:
        own = F.when(which, F.col("value"))
        return [F.percentile_approx(own, points, 100 * ranges), F.max(own), F.min(own)]

    found = rows.agg(*[c.alias(f"c{i}") for i, c in enumerate(cuts(known) + cuts(none))]).first()
    # ranges by falling value, ids before null ids: range k holds values above tops[k + 1] up to tops[k]
    tops, top_none = (sorted({*(found[i] or []), *([] if found[i + 1] is None else [found[i + 1]])}, reverse=True) for i in (0, 3))
    if tops and max(abs(found[1]), abs(found[2])) >= 1 << 53:
        tops = _greatest(rows.where(known), tops)                    # doubles have rounded them
    count = len(tops) + len(top_none)
    rising, rising_none = np.array(tops[::-1], np.int64), np.array(top_none[::-1], np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                ids, values, texts = (part.column(k).to_pylist() for k in range(3))
                own = [count - 1 - int(np.searchsorted(rising_none, v)) if i is None else len(tops) - 1 - int(np.searchsorted(rising, v))
                       for i, v in zip(ids, values)]
                # a row that may head its range is also the last successor of the range above it
                heads: dict[int, int] = {}
                for j, (i, v, k) in enumerate(zip(ids, values, own)):
                    if v == (top_none[k - len(tops)] if i is None else tops[k]) and (k not in heads or texts[j] < texts[heads[k]]):
                        heads[k] = j
                both = pa.array([*range(len(ids)), *heads.values()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own + [(k - 1) % count for k in heads], pa.int32()),
                     pa.array([False] * len(ids) + [True] * len(heads)),
                     *(part.column(k).take(both) for k in range(3))],
                    names=["range", "guest", "doc_id", "value", "text"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by range, own rows first by descending id, then the guest that follows them."""
        held = None                                                 # (range, id, text, fingerprint) awaiting its next
        out: list[tuple] = []

        def flush():
            cols = list(zip(*out)) if out else [()] * 8
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = [c.split()[0] for c in PAIRS.split(", ")]
            out_batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
            out.clear()
            return out_batch

        size = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 100):
                for row in batch.slice(lo, 100).to_pylist():
                    print_ = None
                    if held is not None and held[0] == row["range"]:
                        _, i, text, own = held
                        print_ = fingerprint(row["text"].encode())
                        changed = edit(text, row["text"])
                        print2 = fingerprint(changed.encode())
                        out.append((i, row["doc_id"], len(text), changed, own, print2, likeness(own, print2),
                                    likeness(own, print_)))
                        size += len(changed)
                        if size > 2 << 20:
                            yield flush()
                            size = 0
                    if row["guest"]:
                        held = None                                  # further guests are not first
                    else:
                        held = (row["range"], row["doc_id"], row["text"],
                                print_ or fingerprint(row["text"].encode()))
        yield flush()

    placed = rows.mapInArrow(place, "range int, guest boolean, doc_id long, value long, text string")
    dealt = placed.repartition(parts, "range").sortWithinPartitions("range", "guest", F.col("value").desc(), "text")
    return dealt.mapInArrow(compare, PAIRS)
