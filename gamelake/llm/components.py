"""Connected components of an edge table by alternating large and small stars.

Every round rewires each node's larger neighbours to its smallest one (large star), then
its smaller neighbours (small star); when nothing changes, every edge points from a node
to its component's smallest node. All joins are equi-joins on the node, minima combine
before the shuffle, and each round's edges are a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm.tables import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("c"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    rewired = (down.join(least, F.col("u") == F.col("c"))
               .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")))
    return rewired.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    ``edges``: two columns of longs, in any direction. Loops and repeated edges do no
    harm; nulls are left out; no edges give no rows.
    """
    u, v = edges.columns[:2]
    e = stored(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u != v")
               .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen or not mark["n"]:
            break
        seen, before = mark, e
        e = stored(_small_star(_large_star(before)), "stars")
        discard(before)
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
