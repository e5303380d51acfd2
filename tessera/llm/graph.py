"""Connected components of links between many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.lookup import lookup
from tessera.session import cut_lineage


def components(edges: DataFrame, a: str = "ck", b: str = "other", root: str = "root") -> DataFrame:
    """a, root: each end of ``edges`` (a, b) with the least end that it is connected to.

    Alternating large and small stars.  A node with many neighbours (the centre of a large star) has its
    least one found by partial aggregates and handed out by ``lookup``, so its star is never one task's.
    """
    now = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct())
    check = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    state = check(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours go to the least one
        large = lookup(both.filter("v > u"), least, "u", state[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = cut_lineage(large)
        # small star: a node and its smaller neighbours go to the least of them
        near = lookup(large, large.groupBy("u").agg(F.min("v").alias("m")), "u", state[0])
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        now = cut_lineage(small.filter("u != v").distinct())
        after = check(now)
        if after == state:
            return now.select(F.col("u").alias(a), F.col("v").alias(root))
        state = after
