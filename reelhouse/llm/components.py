"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouping and a join on node ids; a node with many neighbours only adds
rows to a sum, its neighbours are never gathered.  Each round is written to the shared
folder; the number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.chunks import discard, stage


ID_ROWS = 8   # an edge is that much smaller than what shuffle partitions are sized for, at least


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node that has an edge, with the smallest node of its component.
    Nulls and loops count as no edge; repeated edges as one."""
    now = (edges.filter(F.col(a) != F.col(b))
           .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    now, seen = stage(now, "edges", ID_ROWS), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        moved = large.join(low, "u")
        before, now = now, stage(moved.select("u", F.col("low").alias("v"))
                    .unionByName(moved.filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v")))
                    .distinct(), "edges", ID_ROWS)
        discard(before)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
