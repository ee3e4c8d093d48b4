"""Incremental preparation of establishments as they arrive.

The model itself has no unbounded input. What can usefully run as a stream is the first step, the sums by
coordinate; ``workplace_sums`` is the batch aggregation on a streaming table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prepare import filtered_workplaces, weighted_workplaces


def workplace_sums(raw: DataFrame, year: int, bbox, weights) -> DataFrame:
    """Running employment_weight and establishments by coordinate; write it in update or complete mode."""
    rows = weighted_workplaces(filtered_workplaces(raw, year, bbox), weights)
    return rows.groupBy("longitude", "latitude").agg(F.sum("employment_weight").alias("employment_weight"), F.count(F.lit(1)).alias("establishments"))
