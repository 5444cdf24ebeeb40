"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges (a, b), longs; component is the smallest node reachable.

    Alternating large-star and small-star steps, until the edges are stars around their smallest nodes. Each
    round is stored in the shared folder. Null ends and loops are ignored; no edges give no rows.
    """
    now = common.stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        print_ = now.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if print_["n"] == 0 or print_ == seen:
            break
        seen = print_
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        before, now = now, common.stored(small.distinct(), "edges")
        common.dropped(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v"), F.col("v")).distinct())
