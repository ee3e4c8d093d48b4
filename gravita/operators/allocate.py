"""Exact allocation of sorted demands to sorted supplies, as one sweep over their ends.

Within a group both sides are laid end to end, largest first. The places where a stretch of either side
begins cut the whole into parts, each of one owner on either side, and that much goes from one to the other:
as many rows as there are stretches, found by one sort of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _laid(rows: DataFrame, group: str, index: str, size: str, begin: str, end: str) -> DataFrame:
    order = Window.partitionBy(group).orderBy(F.desc(size), index).rowsBetween(Window.unboundedPreceding, 0)
    return rows.filter(F.col(size) > 0).withColumn(end, F.sum(size).over(order)).withColumn(begin, F.col(end) - F.col(size))


def allocate(left: DataFrame, right: DataFrame, group: str, left_index: str, right_index: str, size: str = "size") -> DataFrame:
    """(group, left_index, right_index, size). Unequal totals of a group are an error."""
    lay = lambda rows, index: _laid(rows.select(group, index, size), group, index, size, "pos", "end")
    a = lay(left, left_index).select(group, "pos", F.struct(left_index).alias("a"), F.lit(None).alias("b"))
    b = lay(right, right_index).select(group, "pos", F.lit(None).alias("a"), F.struct(right_index).alias("b"))
    sums = lambda rows, name: rows.filter(F.col(size) > 0).groupBy(group).agg(F.sum(size).alias(name))
    totals = sums(left, "t1").join(sums(right, "t2"), group, "full_outer")
    ok = F.coalesce(F.col("t1"), F.lit(0)) == F.coalesce(F.col("t2"), F.lit(0))
    total = F.when(ok, F.col("t1")).otherwise(F.raise_error(F.lit("The two sides of an allocation have different totals")).cast("long"))
    sweep = Window.partitionBy(group).orderBy("pos")
    owner = lambda c: F.last(c, ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0))
    parts = a.unionByName(b).select(group, "pos", owner("a").alias("a"), owner("b").alias("b"), F.lead("pos").over(sweep).alias("next"))
    parts = parts.join(totals.select(group, total.alias("total")), group).withColumn(size, F.coalesce("next", "total") - F.col("pos"))
    return parts.filter(F.col(size) > 0).select(group, f"a.{left_index}", f"b.{right_index}", size)


def disaggregate(flows: DataFrame, origin_clusters: DataFrame, destination_clusters: DataFrame) -> DataFrame:
    """oc, dc, size: zone flows (o, d, size) taken down to clusters, first at the origins, then at the destinations.

    origin_clusters: o, oc, size; destination_clusters: d, dc, size."""
    outgoing = flows.filter("size > 0")
    segments = allocate(origin_clusters, outgoing, "o", "oc", "d").select("d", "oc", "size")
    return allocate(segments, destination_clusters, "d", "oc", "dc").select("oc", "dc", "size")


def margin_errors(assigned: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Keys whose assigned size isn't their target."""
    sums = assigned.groupBy(key).agg(F.sum("size").alias("assigned"))
    both = targets.select(key, F.col("size").alias("target")).join(sums, key, "full_outer")
    return both.select(key, F.coalesce("target", F.lit(0)).alias("target"), F.coalesce("assigned", F.lit(0)).alias("assigned")).filter("target <> assigned")
