"""Connected components of an edge table by alternating large and small stars.

Every round hangs a node's larger neighbours below its least one, then its smaller ones; the number
of rounds grows with the logarithm of the longest path. Only minima per node and equality joins are
used, so a node with very many edges is neither collected nor expanded. Each round's edges are
written to the shared folder, which cuts lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..scratch import settle


def _linked(pairs: DataFrame) -> DataFrame:
    return pairs.where("u <> v").distinct()


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(
        F.col("v").alias("u"), F.col("u").alias("v")))))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Columns node, component (least node reachable) for every node of ``edges`` (u, v).

    Repeated edges, both directions and loops are allowed; a node that has only a loop is left
    out. Nulls are ignored. No edges give no rows.
    """
    edges = settle(_linked(edges.dropna().select(F.greatest("u", "v").alias("u"),
                                                 F.least("u", "v").alias("v"))))
    state = _state(edges)
    while True:
        # Large star: neighbours above u hang below the least of u and its neighbours.
        near = _both_ways(edges)
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = _linked(near.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")))
        # Small star: u and its neighbours below hang below the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = settle(_linked(large.join(low, "u").select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))))
        if state == (state := _state(edges)):
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
