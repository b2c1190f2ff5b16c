"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import materialize


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One half round on edges (u, v) with u > v.

    Every node points its larger neighbours (small: itself and all its smaller ones) at the
    least of itself and its neighbours.
    """
    seen = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = seen.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    met = seen.join(least, "u")
    if small:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the least node reachable.

    Large-star and small-star rounds, each an aggregate with a map-side part and a join, until
    nothing changes; the number of rounds grows with the logarithm of the longest chain.
    Two numbers a round come to the driver. Self-links and repeated links do no harm.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    before = None
    while True:
        edges = materialize(_stars(_stars(edges, small=False), small=True), "star-edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
    tops = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(tops)
