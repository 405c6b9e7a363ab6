"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.common import cut, drop_cut


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, component): each node of ``edges`` (u, v: long) with the smallest node it reaches.

    Each step keeps at most as many links as there were, so memory per task stays bounded by the
    links of its keys; a step's result is written before the next one starts.  Isolated nodes are
    not returned.  The loop ends when every link points straight at its component's smallest node.
    """
    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(most):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u <> v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        small = cut(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small")
        # done when no node has two parents and no parent has a parent
        heads = small.select(F.col("v").alias("u")).distinct()
        two = small.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        done = not two and not small.join(heads, "u", "left_semi").limit(1).count()
        drop_cut(e, large)
        e = small
        if done:
            break
    else:
        raise RuntimeError(f"components: not settled after {most} steps")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
