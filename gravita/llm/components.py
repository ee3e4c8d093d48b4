"""Connected components by alternating large and small stars, every step a distributed aggregation.

Each large star hangs a node's larger neighbours on its least one, each small star its smaller ones, so
paths shorten by a constant factor a round. Sets of edges are written out between rounds. A node with
very many neighbours is met by map-side combining and by joins whose large partitions Spark can split.

Defined results: edges may repeat, run either way or join a node to itself (such an edge links nothing); an
edge with a null end links nothing; no edges give no nodes; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(scratch: Scratch, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the least node reachable from each node that has an edge.

    ``edges`` has columns u and v of one ordered type; order and repetition don't matter.
    """
    flat = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    flat, before = scratch.write(flat), None
    for _ in range(rounds):
        state = flat.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if state.n == 0 or state == before:
            roots = flat.select(F.col("v").alias("u")).distinct().select(F.col("u").alias("node"), F.col("u").alias("component"))
            return flat.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        after = scratch.write(_small_star(_large_star(flat)))
        scratch.drop(flat)
        flat, before = after, state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
