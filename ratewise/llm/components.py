"""Connected components by alternating stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.scratch import written


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, root (the smallest node reachable) for every node of ``links`` that is not its own root.

    Each round turns every node's larger neighbours, then its smaller ones, towards the smallest it sees, until nothing
    changes: a number of rounds logarithmic in the length of the longest chain. Nothing is collected but a checksum.

    Defined cases: repeated links count once; a link of a node with itself, or with null, links nothing; no links give no rows.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = written(edges, "links")
    state = checksum(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = written(small.select("e.*").where("u > v").distinct(), "links")
        before, state = state, checksum(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
