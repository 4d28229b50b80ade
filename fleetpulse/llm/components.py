"""Connected components of an edge table, by alternating star contractions.

Each round points every node at the smallest node it knows (large star, then
small star), which keeps connectivity and takes a logarithmic number of rounds
in practice.  Rounds are written to the checkpoint folder, so a lost executor
recomputes one round.  A hot centre is a row per neighbour on one side of a
join and a single row on the other, which is an aggregate of the same rows:
adaptive execution may not split such a join, so a centre's neighbours then
meet in one task, streamed and not gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v -> the same connections through smallest neighbours."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    if large:
        moved = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = (both.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
    return moved.where(F.col("u") != F.col("v")).distinct()


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long) that isn't its component's smallest.

    Loops, repeated edges and either direction are allowed; edges with a null
    end are ignored; no edges give no rows.
    """
    edges = (edges.where(F.col("u") != F.col("v"))
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    edges = stage(edges, "edges")
    last = _summary(edges)
    while last[0]:
        edges = stage(_stars(_stars(edges, large=True), large=False), "stars")
        now = _summary(edges)
        if now == last:
            break
        last = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
