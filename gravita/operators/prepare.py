"""Census areas, establishments and regions, cleaned and joined."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.scalar import coerced, first_filled, padded, required, stripped, try_double, weights_map
from ..sources.readers import rings
from .geometry import clean_outline
from .tables import enumerate_rows, last_wins, some

#: Fixed value: names under which an area's id may stand.
ID_NAMES = ("area_id", "cod_indec", "id", "cod_rad")


def with_area_id(features: DataFrame) -> DataFrame:
    found = first_filled(*(F.col("properties")[n] for n in ID_NAMES))
    return features.withColumn("area_id", required(found, "Census area has no stable area identifier"))


def reprojected(features: DataFrame) -> DataFrame:
    """Rings in WGS84. Features without a stated system are taken as Web Mercator; others than these two
    are an error."""
    known = F.coalesce("srid", F.lit(3857))
    out = F.when(known == 3857, geo.to_wgs84(F.col("rings"))).when(known == 4326, F.col("rings"))
    return features.withColumn("rings", F.when(known.isin(3857, 4326), out).otherwise(F.raise_error(F.lit("unknown reference system")).cast("array<array<array<double>>>")))


def checked_stats(stats: DataFrame) -> DataFrame:
    """Statistics with text keys trimmed; of repeated keys the last row (column ord); negatives are an error."""
    bad = (F.col("population") < 0) | (F.col("jobs") < 0)
    keyed = stats.withColumn("area_id", stripped("area_id"))
    keyed = keyed.withColumn("jobs", F.when(bad, F.raise_error(F.lit("negative census statistics")).cast("double")).otherwise(F.col("jobs")))
    return last_wins(keyed, "area_id", "ord")


def census_areas(features: DataFrame, stats: DataFrame, bbox) -> DataFrame:
    """area_id, population, jobs, ord, rings of polygons that meet the box and have statistics; none is an error."""
    shaped = reprojected(with_area_id(rings(features)).filter(F.col("type").isin("Polygon", "MultiPolygon")))
    near = shaped.withColumn("bounds", geo.bounds(F.col("rings"))).filter(geo.overlaps(F.col("bounds"), bbox))
    return some(near.join(checked_stats(stats), "area_id").select("area_id", "population", "jobs", "ord", "rings"), "No area has both a geometry in the box and statistics")


def filtered_workplaces(raw: DataFrame, year: int, bbox) -> DataFrame:
    """longitude, latitude, band of the year's rows with coordinates in the box. A year that is no number
    is an error, a coordinate that is none skips its row."""
    ok = raw.filter(F.col("anio").cast("int") == year)
    ok = ok.select(try_double("lon").alias("longitude"), try_double("lat").alias("latitude"), stripped("empleo").alias("band"))
    return ok.filter(geo.inside(F.col("longitude"), F.col("latitude"), bbox))


def weighted_workplaces(rows: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Adds employment_weight; an unknown band is an error, but only among rows that passed the filters."""
    w = weights_map(weights)[F.col("band")]
    unknown = F.raise_error(F.concat(F.lit("No weight is known for employment band "), F.coalesce("band", F.lit("")))).cast("double")
    return rows.withColumn("employment_weight", F.coalesce(w, unknown))


def workplaces(raw: DataFrame, year: int, bbox, weights: Mapping[str, float], grid: float) -> DataFrame:
    """One row for each coordinate: workplace_id, cell_id, longitude, latitude, employment_weight, establishments."""
    rows = weighted_workplaces(filtered_workplaces(raw, year, bbox), weights)
    found = rows.groupBy("longitude", "latitude").agg(F.sum("employment_weight").alias("employment_weight"), F.count(F.lit(1)).alias("establishments"))
    numbered = enumerate_rows(found, "n", "longitude", "latitude")
    x, y = geo.bucket(F.col("longitude"), grid), geo.bucket(F.col("latitude"), grid)
    return numbered.select(
        padded("work_", 6, F.col("n")).alias("workplace_id"), F.concat_ws("_", F.lit("cell"), x, y).alias("cell_id"),
        "longitude", "latitude", "employment_weight", "establishments",
    )


def wanted_features(features: DataFrame, wanted: DataFrame) -> DataFrame:
    """Features with an id in the list and a geometry that is neither null nor empty."""
    kept = features.join(wanted, "area_id", "left_semi")
    return kept.filter(F.col("rings").isNotNull() & (F.size("rings") > 0))


def region_rollup(areas: DataFrame, city_prefix: str = "02") -> DataFrame:
    """region_id, name, region_type, population, jobs: sums over the first five characters of the id.

    ``areas`` has area_id, population and jobs as text, name and ord. Texts that are no numbers count as 0,
    others are rounded before they are summed. Areas under the city prefix have their own type; a region
    without a name gets one from its id."""
    rows = areas.withColumn("region_id", F.substring("area_id", 1, 5))
    named = F.min_by("name", F.when(F.col("name").isNotNull(), F.col("ord")))
    whole = lambda c: F.sum(F.rint(coerced(c)).cast("long")).alias(c)
    sums = rows.groupBy("region_id").agg(whole("population"), whole("jobs"), named.alias("name"))
    city = F.col("region_id").startswith(city_prefix)
    fallback = F.concat(F.when(city, F.lit("Comuna ")).otherwise(F.lit("Partido ")), "region_id")
    kind = F.when(city, F.lit("comuna")).otherwise(F.lit("partido"))
    return sums.select("region_id", F.coalesce("name", fallback).alias("name"), kind.alias("region_type"), "population", "jobs")


def boundary_segments(areas: DataFrame) -> DataFrame:
    """Segments on the outline of each region (columns region_id, rings): a segment that two areas of a
    region share lies inside and cancels. Exact for areas that share their vertices."""
    ring = areas.select("region_id", F.explode("rings").alias("ring"))
    pairs = F.expr("transform(sequence(1, size(ring) - 1), i -> struct(ring[i - 1] as a, ring[i] as b))")
    s = ring.filter(F.size("ring") > 1).select("region_id", F.explode(pairs).alias("s"))
    flip = F.col("s.a") > F.col("s.b")
    ends = s.select("region_id", F.when(flip, F.col("s.b")).otherwise(F.col("s.a")).alias("a"), F.when(flip, F.col("s.a")).otherwise(F.col("s.b")).alias("b"))
    return ends.groupBy("region_id", "a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select(
        "region_id", F.col("a")[0].alias("x1"), F.col("a")[1].alias("y1"), F.col("b")[0].alias("x2"), F.col("b")[1].alias("y2")
    )


def cleaned_buildings(features: DataFrame, meridian: float, least_area: float, snap: float = 0.5, tolerance: float = 0.25) -> DataFrame:
    """Building outlines, one row for each part of more than an area: projected to metres about a meridian,
    snapped, thinned and taken back to degrees of five places (column shape)."""
    parts = single_parts(features, None)
    return parts.withColumn("shape", clean_outline("shape", meridian, snap, least_area, tolerance)).filter("shape IS NOT NULL")


def single_parts(features: DataFrame, places: int | None = 5) -> DataFrame:
    """MultiPolygons as one row for each part, coordinates rounded if asked for."""
    single = F.array(F.from_json("coordinates", "array<array<array<double>>>"))
    several = F.from_json("coordinates", "array<array<array<array<double>>>>")
    parts = F.when(F.col("type") == "Polygon", single).otherwise(several)
    rows = features.filter(F.col("type").isin("Polygon", "MultiPolygon")).select("*", F.posexplode(parts).alias("part", "shape"))
    if places is None:
        return rows
    near = F.transform("shape", lambda r: F.transform(r, lambda p: F.transform(p, lambda c: F.round(c, places))))
    return rows.withColumn("shape", near)
