"""Population records and demand points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.scalar import padded
from .tables import enumerate_rows, first_wins


def merged_points(points: DataFrame) -> DataFrame:
    """lon, lat, id: points at exactly the same place are one, with the id that came first (column ord)."""
    return first_wins(points.select("lon", "lat", "id", "ord"), ["lon", "lat"], "ord")


def chunks(rows: DataFrame, size: str, most: int) -> DataFrame:
    """Each row as often as it needs to hold its size in parts of at most ``most`` (columns part, chunk)."""
    if most <= 0:
        raise ValueError("A population cannot be smaller than one")
    parts = F.sequence(F.lit(0).cast("long"), F.ceil(F.col(size) / most).cast("long") - 1)
    cut = rows.filter(F.col(size) > 0).withColumn("part", F.explode(parts))
    return cut.withColumn("chunk", F.least(F.lit(most).cast("long"), F.col(size) - F.col("part") * most))


def populations(assigned: DataFrame, residual: DataFrame, points: DataFrame, most: int) -> DataFrame:
    """id, residenceId, jobId, drivingSeconds, drivingDistance, size.

    assigned: oc, dc, size; residual: oc, size, who stay where they are; points: cluster, id, lon, lat.
    Numbered by phase, destination and origin cluster, and part."""
    home = points.select(F.col("cluster").alias("oc"), F.col("id").alias("residenceId"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1"))
    job = points.select(F.col("cluster").alias("dc"), F.col("id").alias("jobId"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    every = assigned.select("oc", "dc", "size", F.lit(0).alias("phase")).unionByName(residual.select("oc", F.col("oc").alias("dc"), "size", F.lit(1).alias("phase")))
    placed = every.join(home, "oc").join(job, "dc")
    km = F.when(F.col("phase") == 1, F.lit(0.0)).otherwise(geo.haversine_km(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2")))
    rows = enumerate_rows(chunks(placed.withColumn("km", km), "size", most), "n", "phase", "dc", "oc", "part")
    return rows.select(
        padded("pop_", 8, F.col("n")).alias("id"), "residenceId", "jobId", geo.driving_seconds(F.col("km")).alias("drivingSeconds"),
        geo.driving_metres(F.col("km")).alias("drivingDistance"), F.col("chunk").alias("size"),
    )


def roles(pops: DataFrame) -> DataFrame:
    """Each population once for each point it belongs to: point, pop, residents, jobs, listed."""
    zero = F.lit(0).cast("long")
    at_home = pops.select(F.col("residenceId").alias("point"), F.col("id").alias("pop"), F.col("size").alias("residents"), zero.alias("jobs"), F.lit(True).alias("listed"))
    at_work = pops.select(F.col("jobId").alias("point"), F.col("id").alias("pop"), zero.alias("residents"), F.col("size").alias("jobs"), (F.col("jobId") != F.col("residenceId")).alias("listed"))
    return at_home.unionByName(at_work)


def point_totals(pops: DataFrame) -> DataFrame:
    """point, residents, jobs."""
    return roles(pops).groupBy("point").agg(F.sum("residents").alias("residents"), F.sum("jobs").alias("jobs"))


def point_pop_ids(pops: DataFrame) -> DataFrame:
    """point, popIds in order of creation; a population that stays at its point is listed once."""
    order = F.array_sort(F.collect_list(F.struct(F.length("pop").alias("n"), "pop")))  # longer ids have larger numbers
    return roles(pops).filter("listed").groupBy("point").agg(F.transform(order, lambda p: p["pop"]).alias("popIds"))


def demand_points(points: DataFrame, pops: DataFrame) -> DataFrame:
    """id, location, jobs, residents, popIds of the points that have either."""
    sums = point_totals(pops).join(point_pop_ids(pops), "point")
    return points.join(sums, points["id"] == sums["point"]).select("id", F.array("lon", "lat").alias("location"), "jobs", "residents", "popIds")
