"""Connected components of an edge list, by alternating large-star and small-star steps.

Each step is two aggregations and a join on node ids; a node's neighbours are never
collected. The edge list is written to the shared folder after each round, so the
lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
    return tuple(r)


#: Edges that one task handles, about: a small edge list takes a few tasks, not one for each shuffle partition.
EDGES_A_TASK = 100_000


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node id that can be reached) for every node of the edges (u, v)."""
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tasks = -(-edges.count() // EDGES_A_TASK) or 1
    now = cut(edges.coalesce(tasks).distinct().coalesce(tasks))
    mark = _mark(now)
    while mark[0]:
        # large star: neighbours above u move to the least of u and its neighbours
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).coalesce(tasks)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").coalesce(tasks).distinct().coalesce(tasks)
        # small star: u and its neighbours below it move to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).coalesce(tasks).distinct().coalesce(tasks)
        now = cut(small)
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct().coalesce(tasks))
