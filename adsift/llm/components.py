"""Connected components of a large edge table.

Large-star and small-star steps in turn: in a large star every node hangs its
larger neighbours under its smallest one, in a small star the smaller ones.
The edges end as stars around each component's smallest node. A node's
smallest neighbour is an aggregate (combined before the shuffle) that is
written and joined back, so no list of neighbours is ever held, and AQE splits
a hot centre's rows. Each round is written to shared storage, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.strategy import write_table


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).collect()[0])


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = write_table(both.groupBy(F.col("u").alias("c")).agg(F.min(F.least("u", "v")).alias("m")), "smallest")
    return both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger node ``u`` to the smaller ``v``."""
    least = write_table(edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")), "smallest")
    moved = edges.join(least, F.col("u") == F.col("c")).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs -> (node, root): every node with an edge to another, root the smallest of its component."""
    directed = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = write_table(directed, "edges")
    state = _state(now)
    while state[0]:
        now = write_table(small_star(write_table(large_star(now), "edges")), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
