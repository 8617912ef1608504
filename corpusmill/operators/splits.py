"""Even batches and exact, repeatable train/test/valid splits.

Ranks come from a seeded hash of the key, so a split is repeatable and equal
to the same ranking in SQL. Exact sizes follow the reference's ceilings:
test+valid = ceil(0.2 n), valid = ceil(that / 3), computed in doubles as the
reference's splitter does.

The splits sort nothing: histograms over hash prefixes narrow down the two boundary
values, and every row is labelled by comparing with them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.rowindex import rows_at_hash_ranks, rows_at_ranks, with_row_index

# The reference's split fractions.
HOLDOUT_FRACTION = 0.2
VALID_FRACTION = 1 / 3
SPLIT_NAMES = ("train", "test", "valid")


def split_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def split_sizes(n: int) -> tuple[int, int, int]:
    """(train, test, valid) sizes for n rows."""
    holdout = math.ceil(n * HOLDOUT_FRACTION)
    valid = math.ceil(holdout * VALID_FRACTION)
    return n - holdout, holdout - valid, valid


def _below(h: Column, k: Column, bound: tuple | None) -> Column:
    if bound is None:
        return F.lit(True)
    bh, bk = bound
    return (h < F.lit(bh)) | ((h == F.lit(bh)) & (k < F.lit(bk)))


def _boundary_ranks(n: int) -> list[int]:
    n_train, n_test, _ = split_sizes(n)
    return [n_train, n_train + n_test]


def _label(df: DataFrame, h: Column, k: Column, probe: DataFrame, name: str) -> DataFrame:
    """Label rows by comparing (h, k) with the (hash, key) values at the two ranks.

    ``probe`` holds one ``(_sh, _sk)`` row per ranked unit (row or group); the
    unit count comes from the ranking pass itself.
    """
    b_train, b_test = rows_at_hash_ranks(probe, "_sh", "_sk", _boundary_ranks)
    label = (F.when(_below(h, k, b_train), F.lit("train"))
              .when(_below(h, k, b_test), F.lit("test"))
              .otherwise(F.lit("valid")))
    return df.withColumn(name, label)


def split_three_way(df: DataFrame, key: str, seed: int = 0, name: str = "split") -> DataFrame:
    """label each row train/test/valid by rank of md5(seed:key).

    ``key`` must be unique per row.
    """
    h, k = split_hash(F.col(key), seed), F.col(key).cast("string")
    return _label(df, h, k, df.select(h.alias("_sh"), k.alias("_sk")), name)


def split_exact(df: DataFrame, key: str, seed: int = 0, fraction: float = HOLDOUT_FRACTION,
                name: str = "split") -> DataFrame:
    """two-way split, ``ceil(fraction * n)`` rows in ``test``."""
    h, k = split_hash(F.col(key), seed), F.col(key).cast("string")
    (b_train,) = rows_at_hash_ranks(df.select(h.alias("_sh"), k.alias("_sk")), "_sh", "_sk",
                                    lambda n: [n - math.ceil(n * fraction)])
    return df.withColumn(name, F.when(_below(h, k, b_train), "train").otherwise("test"))


def split_grouped(df: DataFrame, group: str, seed: int = 0, name: str = "split") -> DataFrame:
    """rank distinct groups instead of rows, so a group never straddles splits.

    Distinct groups come from a partial (map-side) aggregation, so a hot group
    costs one row per task; rows are then labelled by comparison, without a join.
    """
    groups = df.select(F.col(group).alias("_g")).distinct()
    probe = groups.select(split_hash(F.col("_g"), seed).alias("_sh"),
                          F.col("_g").cast("string").alias("_sk"))
    h, k = split_hash(F.col(group), seed), F.col(group).cast("string")
    return _label(df, h, k, probe, name)


def hash_split(key: Column, seed: int = 0) -> Column:
    """Streaming form of F2: train/test/valid by a threshold on md5(seed:key).

    Row-wise, so it runs per micro-batch; the fractions (0.8 / 0.1333 / 0.0667)
    hold only in expectation, unlike the exact batch split.
    """
    u = F.conv(F.substring(split_hash(key, seed), 1, 8), 16, 10).cast("double") / float(2 ** 32)
    valid_share = HOLDOUT_FRACTION * VALID_FRACTION
    return (F.when(u < 1 - HOLDOUT_FRACTION, F.lit("train"))
             .when(u < 1 - valid_share, F.lit("test"))
             .otherwise(F.lit("valid")))


def shuffle_order(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """a repeatable random row order."""
    return df.orderBy(split_hash(F.col(key), seed), F.col(key))


def shuffle_rank(df: DataFrame, key: str, seed: int = 0, name: str = "rank") -> DataFrame:
    """F3 as a column: each row's place (from 0) in the order of ``shuffle_order``."""
    hashed = df.withColumn("_sh", split_hash(F.col(key), seed))
    return with_row_index(hashed, ["_sh", key], name).drop("_sh")


def assign_batches(df: DataFrame, order_cols: list[str], num_batches: int,
                   name: str = "batch") -> DataFrame:
    """Contiguous batches of ceil(n / k) rows in order (may give fewer than k).

    The k-1 boundary keys are found on the ordering columns alone; each row's
    batch is the number of boundaries at or below its key. Rows with equal keys are
    numbered in their sorted order, so sizes hold with ties as well.
    """
    if num_batches < 1:
        raise ValueError("num_batches must be >= 1")

    def ranks(n: int) -> list[int]:
        size = math.ceil(n / num_batches) if n else 1
        return list(range(size, n, size))

    # each boundary with the row before it: equal keys there can't be told apart by comparison
    pairs = rows_at_ranks(df.select(*order_cols), order_cols, lambda n: [x for r in ranks(n) for x in (r - 1, r)])
    if any(a == b for a, b in zip(pairs[::2], pairs[1::2])):
        total = "_batch_total"                                       # number the rows themselves
        indexed = with_row_index(df, order_cols, "_batch_row", total)
        size = F.greatest(F.ceil(F.col(total) / F.lit(num_batches)), F.lit(1))
        return indexed.withColumn(name, F.floor(F.col("_batch_row") / size).cast("bigint")).drop("_batch_row", total)
    bounds = pairs[1::2]
    if not bounds:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    key = F.struct(*[F.col(c).alias(c) for c in order_cols])
    lits = F.array(*[F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order_cols, b)])
                     for b in bounds])
    return df.withColumn(name, F.size(F.filter(lits, lambda b: b <= key)).cast("bigint"))
