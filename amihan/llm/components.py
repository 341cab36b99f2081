"""Connected components of a graph given as edges, each named by its smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amihan.llm.common import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
    return row["n"], int(row["sum"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node that is not the smallest of its component, with the smallest.

    Large-star and small-star steps alternate until nothing changes: nodes
    connect to the smallest neighbour, and the number of rounds grows as the
    logarithm of the longest path.  Minima are aggregated before the shuffle
    and joined back, so no node's neighbours are ever gathered.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "components")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(lowest, "u")
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "components")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
