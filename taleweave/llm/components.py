"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taleweave.llm.common import settled


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of undirected edges (u, v): the least node
    that is reachable. Large-star and small-star rounds turn every component
    into a star; each round is written to the shared folder."""
    edges = settled(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # every larger neighbour of a node is sent to the node's least neighbour
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u <> v").distinct()
        # then every node's smaller neighbours, and itself, to the least of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        edges = settled(moved.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
