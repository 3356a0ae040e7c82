"""Connected components of an edge list by alternating large-star and small-star steps.

Each step is an aggregation (map-side partial minimum) and a join on the node; a hub with many
neighbours only makes its key frequent, which adaptive skew joins split. Edges are cut to the reliable
checkpoint folder every round; rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabtext.session import cut_lineage


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component.
    Null ends and loops are ignored. Nodes may be of any orderable type."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e = cut_lineage(e)
    while True:
        # large star: larger neighbours of u are linked to the smallest node around u
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.where(F.col("v") > F.col("u")).join(low, "u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours of u, and u, are linked to the smallest of them
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        new = big.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                          F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")) \
            .select("x.u", "x.v").where(F.col("u") != F.col("v")).distinct()
        new = cut_lineage(new)
        if _signature(new) == _signature(e):
            return new.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .union(new.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        e = new


def _signature(e: DataFrame) -> tuple:
    """Count and order-free hash of a set of edges: equal for equal sets."""
    r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(r)
