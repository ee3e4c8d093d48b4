"""The figures of a run, as one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .tables import size_summary, weighted_percentiles


def weighted_mean(df: DataFrame, value: str, weight: str, out: str) -> DataFrame:
    """One row; 0 without weight."""
    total = F.sum(weight)
    return df.agg(F.coalesce(F.sum(F.col(value) * F.col(weight)) / F.when(total != 0, total), F.lit(0.0)).alias(out))


def commute_figures(flows: DataFrame, weight: str, prefix: str) -> DataFrame:
    """mean, p50, p90 and largest km of flows (km and a weight), which several passes read."""
    found = [
        weighted_mean(flows, "km", weight, f"{prefix}_mean_km"),
        weighted_percentiles(flows, "km", weight, {f"{prefix}_p50_km": 0.5, f"{prefix}_p90_km": 0.9}),
        flows.agg(F.coalesce(F.max("km"), F.lit(0.0)).alias(f"{prefix}_max_km")),
    ]
    return reduce(lambda a, b: a.crossJoin(b), found)


def with_km(flows: DataFrame, origins: DataFrame, destinations: DataFrame, o: str, d: str) -> DataFrame:
    a = origins.select(F.col(origins.columns[0]).alias(o), F.col("lon").alias("lon1"), F.col("lat").alias("lat1"))
    b = destinations.select(F.col(destinations.columns[0]).alias(d), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    return flows.join(a, o).join(b, d).withColumn("km", geo.haversine_km(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2")))


def output_figures(points: DataFrame, pops: DataFrame) -> DataFrame:
    """points, job_points, resident_points, duplicate_coordinates, populations and sizes."""
    counts = points.agg(
        F.count(F.lit(1)).alias("points"), F.count_if(F.col("jobs") > 0).alias("job_points"), F.count_if(F.col("residents") > 0).alias("resident_points"),
        (F.count(F.lit(1)) - F.count_distinct(F.col("location"))).alias("duplicate_coordinates"),
    )
    sizes = size_summary(pops, "size")
    sizes = sizes.select(*(F.col(c).alias(f"population_size_{c}") for c in sizes.columns))
    return counts.crossJoin(pops.agg(F.count(F.lit(1)).alias("populations"))).crossJoin(sizes)


def cluster_figures(clusters: DataFrame) -> DataFrame:
    out = None
    for column, name in (("radio_count", "radios_per_cluster"), ("employed", "employed_per_cluster")):
        s = size_summary(clusters, column).select(*(F.col(c).alias(f"{name}_{c}") for c in ("median", "p90", "max")))
        out = s if out is None else out.crossJoin(s)
    return out
