"""Connected components of a link table, in logarithmically many joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm.base import step


def components(links: DataFrame) -> DataFrame:
    """``links`` has columns a and b; returns node and component, the least node
    reachable, for every node that has a link.

    Large-star and small-star steps take turns: neighbours above a node are tied to
    the least of its neighbourhood, then those below are.  Minima are pre-aggregated
    and hot nodes are split by the skew handling of the join; every round is written
    to the shared folder."""
    now = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, mark = step(now, "links"), None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        now = step(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct(), "links")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
