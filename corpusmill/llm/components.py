"""Connected components of an edge table by alternating large-star and small-star joins.

The driver sees one count per round; links and labels stay in DataFrames, and each
round is cut with a reliable checkpoint in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of itself and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``u, v`` links (any order, no loops needed) -> ``node, root`` with the smallest reachable node.

    Nodes without a link are absent. A star join per node touches each link a constant
    number of times, and minima are combined before their shuffle, so a node with very
    many links only makes its own minimum's partial sums.
    """
    current = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if current.isEmpty():
        return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    mark = None
    while True:
        current = cut_lineage(_small_star(_large_star(current).distinct()).distinct())
        # a forest of stars: no root is anyone's child, and each child has one root
        now = current.agg(F.count("*"), F.count_distinct("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
