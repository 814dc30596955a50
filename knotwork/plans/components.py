"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knotwork.plans.lineage import cut


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): each node of ``edges`` (u, v) with the least node that it reaches.

    Alternates the two star steps: every node hands its greater neighbours, then its lesser ones, to the least node it
    sees. Edges never grow in number, and the rounds follow the logarithm of the longest path. Null ends are left out.
    Each round is cut in the shared folder."""
    now = edges.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).where("u > v").distinct()  # u > v: from the greater to the lesser
    now, before = cut(now), None
    for _ in range(rounds):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        lesser = large.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        small = lesser.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u > v").distinct()
        now = cut(small)
        after = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
