"""Connected components of a link table by alternating large and small stars.

Each round is two aggregations by vertex and a join back; a hot vertex is
pre-aggregated before its shuffle and its join is split by adaptive execution.
Rounds end when the links no longer change; every round is written to the
shared folder, so nothing depends on the executors that made it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, "u").filter("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link.

    ``edges`` has two long columns; their order, repeats and loops do not
    matter; a link with a null end is no link. An empty table gives none.
    """
    u, v = edges.columns[:2]
    now = saved(edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
                .filter("u != v").distinct(), "links")
    state = _digest(now)
    while state[0]:
        now = saved(_small_star(_large_star(now)), "stars")
        new = _digest(now)
        if new == state:
            break
        state = new
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
