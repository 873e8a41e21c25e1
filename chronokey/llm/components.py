"""Connected components by alternating large-star and small-star steps.

Edges stay in tables in the shared folder; nothing is collected. Each step joins a
node's smallest neighbour back to its edges instead of gathering neighbours, so a
node with very many edges is never one task's group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` has u > v. Links each node's neighbours to the smallest of them."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    joined = both.join(least, both.u == least.k)
    out = joined.filter("v > u" if large else "v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(joined.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of ``edges`` (a, b) is linked to; ids without links are left out."""
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    now, seen = saved(pairs, "edges"), None
    while True:
        # Ids take all 64 bits, so they are not summed as longs.
        mark = F.xxhash64("u", "v")
        state = now.agg(F.count("*"), F.bit_xor(mark), F.sum(mark.cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        now = saved(_star(_star(now, True), False), "edges")
    roots = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
