"""Global order positions without a single-partition window.

``with_row_index`` sorts with a range exchange, cuts lineage with a reliable
checkpoint (so partition contents and order are fixed), counts rows per
partition, and adds the exclusive prefix sum of those counts to each row's
position inside its partition. Only the counts (one row per partition) reach
the driver, so what is collected is bounded by the partition count.

``rows_at_hash_ranks`` finds the rows at a few ranks of an order by a hash, without
sorting or writing anything: histograms over ever longer hash prefixes narrow each rank
down to a few rows.

``rows_at_ranks`` finds the rows at a few given ranks the same way, but reads
only the ordering columns and returns the boundary values, so callers can
label the full table with a comparison instead of carrying it through a sort.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import cut_lineage

_PID, _MID, _CNT, _OFF = "_rx_pid", "_rx_mid", "_rx_cnt", "_rx_off"


def _sorted_tagged(df: DataFrame, order_cols: Sequence[str | Column]) -> DataFrame:
    ordered = cut_lineage(df.orderBy(*order_cols))
    return ordered.select("*", F.spark_partition_id().alias(_PID),
                          F.monotonically_increasing_id().alias(_MID))


def _local_pos() -> Column:
    # monotonically_increasing_id = (partition index << 33) + position in partition
    return F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)


def _partition_offsets(tagged: DataFrame) -> tuple[list[int], list[int], int]:
    """Row counts and exclusive prefix sums per partition (one row per partition)."""
    counts = dict(tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT)).collect())
    n_parts = max(counts) + 1 if counts else 0
    sizes = [int(counts.get(p, 0)) for p in range(n_parts)]
    offsets, acc = [], 0
    for c in sizes:
        offsets.append(acc)
        acc += c
    return offsets, sizes, acc


def with_row_index(df: DataFrame, order_cols: Sequence[str | Column], name: str = "row_index",
                   total_name: str | None = None) -> DataFrame:
    """0-based position of each row in ``order_cols`` order (make the order total).

    The per-partition offsets become an array literal indexed by partition id,
    so the final projection is narrow: no join, no single-partition stage.
    """
    tagged = _sorted_tagged(df, order_cols)
    offsets, _, total = _partition_offsets(tagged)
    if not offsets:
        out = tagged.withColumn(name, F.lit(None).cast("long"))
    else:
        base = F.element_at(F.lit(offsets).cast("array<bigint>"), F.col(_PID) + 1)
        out = tagged.withColumn(name, base + _local_pos())
    cols = list(df.columns) + [name]
    if total_name:
        out = out.withColumn(total_name, F.lit(total).cast("bigint"))
        cols.append(total_name)
    return out.select(*cols)


def with_total_before(df: DataFrame, order_cols: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows before each one in ``order_cols`` order (make the order total).

    Sums per sorted partition reach the driver; within a partition a window adds up.
    """
    tagged = _sorted_tagged(df, order_cols).drop(_MID)
    sums = dict(tagged.groupBy(_PID).agg(F.sum(value).alias(_CNT)).collect())
    offsets = [0]
    for p in range(max(sums, default=-1) + 1):
        offsets.append(offsets[-1] + int(sums.get(p) or 0))
    inside = Window.partitionBy(_PID).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    base = F.element_at(F.lit(offsets).cast("array<bigint>"), F.col(_PID) + 1)
    return tagged.withColumn(name, base + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop(_PID)


def rows_at_ranks(df: DataFrame, order_cols: Sequence[str],
                  ranks: Sequence[int] | Callable[[int], Sequence[int]]) -> list:
    """Values of ``order_cols`` at the given 0-based ranks (None past the end).

    ``ranks`` may be a function of the row count ``n``, which comes from the
    same pass (no separate count). Only ``order_cols`` are sorted and
    checkpointed; the result has one entry per requested rank, so it is safe
    to bring to the driver.
    """
    tagged = _sorted_tagged(df.select(*order_cols), order_cols)
    offsets, sizes, total = _partition_offsets(tagged)
    if callable(ranks):
        ranks = list(ranks(total))
    wanted = {}
    for r in ranks:
        for pid, (off, size) in enumerate(zip(offsets, sizes)):
            if off <= r < off + size:
                wanted[r] = (pid, r - off)
    if not wanted:
        return [None] * len(ranks)
    # monotonically_increasing_id names (partition, position): a set lookup at any number of ranks
    cond = F.col(_MID).isin([(pid << 33) + pos for pid, pos in wanted.values()])
    found = {(r[_PID], r["_rx_pos"]): tuple(r[c] for c in order_cols)
             for r in tagged.where(cond).select(*order_cols, _PID,
                                                _local_pos().alias("_rx_pos")).collect()}
    return [found.get(wanted[r]) if r in wanted else None for r in ranks]


def rows_at_hash_ranks(df: DataFrame, hash_col: str, key_col: str,
                       ranks: Sequence[int] | Callable[[int], Sequence[int]], digits: int = 3,
                       few: int = 10_000) -> list[tuple[str, str] | None]:
    """``(hash, key)`` at the given 0-based ranks of the order by hash, then key (None past the end).

    ``hash_col`` holds hex digits of one length that are spread evenly, as a digest's. A
    pass counts rows by the next ``digits`` digits within the prefixes still wanted, and
    rows are fetched once no such prefix has more than ``few`` of them: two or three
    passes for 10^11 rows, each a partial aggregate of at most 16 ** digits counts a prefix.
    """
    h, length = F.coalesce(F.col(hash_col), F.lit("!")), digits      # a null hash comes first
    counts = _prefix_counts(df, h, length)
    total = sum(counts.values())
    wanted = list(ranks(total) if callable(ranks) else ranks)
    # rank within the rows of a prefix, which only gets longer
    where = {r: _locate(counts, r) for r in wanted if 0 <= r < total}
    sizes = {p: counts[p] for p, _ in where.values()}
    whole = _hash_length(df, h) if sizes else 0
    while sizes and max(sizes.values()) > few and length < whole:
        length += digits
        counts = _prefix_counts(df.where(_has_prefix(h, sizes)), h, length)
        for r, (p, rest) in where.items():
            where[r] = _locate({q: n for q, n in counts.items() if q.startswith(p)}, rest)
        sizes = {p: counts[p] for p, _ in where.values()}
    found = {}
    if sizes:
        rows = df.where(_has_prefix(h, sizes)).select(h.alias("h"), F.col(key_col).alias("k"))
        if length >= whole:                                          # equal hashes are equal keys
            rows = rows.distinct()
        for r in rows.collect():
            found.setdefault(r["h"][:length], []).append((r["h"], r["k"]))
    out = []
    for r in wanted:
        own = sorted(found.get(where[r][0], [])) if r in where else []
        out.append(own[min(where[r][1], len(own) - 1)] if own else None)
    return out


def _prefix_counts(df: DataFrame, h: Column, length: int) -> dict[str, int]:
    rows = df.groupBy(F.substring(h, 1, length).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["p"]: r["n"] for r in sorted(rows, key=lambda r: r["p"])}


def _locate(counts: dict[str, int], rank: int) -> tuple[str, int]:
    """The prefix that holds the row of this rank, and the rank within it."""
    for prefix in sorted(counts):
        if rank < counts[prefix]:
            return prefix, rank
        rank -= counts[prefix]
    raise IndexError(rank)


def _has_prefix(h: Column, prefixes: dict[str, int]) -> Column:
    cond = F.lit(False)
    for p in sorted(prefixes):
        cond = cond | h.startswith(p)
    return cond


def _hash_length(df: DataFrame, h: Column) -> int:
    return df.agg(F.max(F.length(h))).first()[0] or 0
