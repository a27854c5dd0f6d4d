"""Connected components of an edge table, as Spark joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.plans.storage import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of the undirected edges; root is the smallest node.

    Alternating large-star and small-star steps: each keeps the components and
    pulls nodes towards their minimum, until the edges form stars.  A node's
    minimum is a map-side combined aggregate, so a hub of any size ships one
    row per task and node; no group is gathered.  Each round is written to the
    shared folder.  Null ends and self links are ignored; repeated edges and
    an empty table are fine.
    """
    e = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                    .where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "edges")
    before = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u AND v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.where("m <> u").select("u", F.col("m").alias("v"))).distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small, "stars")
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
                      .alias("h")).first()
        if state == before:
            break
        before = state
    found = e.groupBy("u").agg(F.min("v").alias("root"))
    roots = e.select(F.col("v").alias("node")).distinct().join(
        found.select(F.col("u").alias("node")), "node", "left_anti")
    return (found.select(F.col("u").alias("node"), "root")
            .union(roots.select("node", F.col("node").alias("root"))))
