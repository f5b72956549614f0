"""Connected components by alternating star rounds, each a few shuffles with partial aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import saved


def _rewired(edges: DataFrame, smaller: DataFrame) -> DataFrame:
    return edges.join(smaller, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of the edges ``a, b``.

    A large-star round hands every larger neighbour the smallest neighbour, a small-star round does
    the same for the smaller ones; the number of rounds grows with the logarithm of the longest path.
    Minima are combined before the shuffle and the joins can be split, so a node with very many
    neighbours does no harm. Loops and repeated edges do not matter; no edges give no rows.
    """
    now = saved(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    seen = None
    while True:
        stamp = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if stamp == seen or not stamp[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = stamp
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = saved(
            _rewired(both, lowest).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large"
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _rewired(large, lowest).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "small")
