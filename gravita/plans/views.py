"""Census-like views of the test tables, which hold no geography. The arithmetic is exact in doubles, so
that any engine finds the same coordinates. The SQL texts say the same for DuckDB."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..config import Config

BBOX = Config().bbox
ZONE_DEGREES = 0.2
YEAR = 2000
WEIGHTS = Config().employment_weights


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def radios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS radio",
        "lpad(cast(c_custkey AS string), 9, '0') AS area_id",
        "-59.4e0 + 1.7e0 * cast((c_custkey * 7919) % 10007 AS double) / 10007e0 AS lon",
        "-35.2e0 + cast((c_custkey * 104729) % 10009 AS double) / 10009e0 AS lat",
        "cast(floor(abs(c_acctbal) / 10e0) AS bigint) + 1 AS employed",
    )


def establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows as text, as a CSV would give them."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "cast(year(o_orderdate) AS string) AS anio",
        "CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE cast(-59.5e0 + cast((o_orderkey * 31) % 190 AS double) / 100e0 AS string) END AS lon",
        "cast(-35.25e0 + cast((o_orderkey * 17) % 110 AS double) / 100e0 AS string) AS lat",
        "concat(' ', CASE o_orderpriority WHEN '1-URGENT' THEN 'e. 500+' WHEN '2-HIGH' THEN 'd. 200-499' WHEN '3-MEDIUM' THEN 'c. 50-199'"
        " WHEN '4-NOT SPECIFIED' THEN 'b. 10-49' ELSE 'a. 1-9' END, ' ') AS empleo",
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON collection for each region: a square in Web Mercator for each nation, every fifth a
    MultiPolygon of two, under three different id names."""
    square = (
        "concat('[[[', x, ',', y, '],[', x + 20000, ',', y, '],[', x + 20000, ',', y + 20000, '],[', x, ',', y + 20000, '],[', x, ',', y, ']]]')"
    )
    rows = table(spark, sf_dir, "nation").selectExpr(
        "*", "-6600000 + n_nationkey * 12000 AS x", "-4150000 + n_nationkey * 9000 AS y",
        "CASE n_nationkey % 3 WHEN 0 THEN 'area_id' WHEN 1 THEN 'cod_indec' ELSE 'cod_rad' END AS id_name", "lpad(cast(n_nationkey AS string), 9, '0') AS id",
    )
    shape = f"CASE WHEN n_nationkey % 5 = 0 THEN concat('\"MultiPolygon\",\"coordinates\":[', {square}, ',', {square}, ']') ELSE concat('\"Polygon\",\"coordinates\":', {square}) END"
    one = f"concat('{{\"properties\":{{\"', id_name, '\":\" ', id, ' \",\"dpto\":\"', n_name, '\"}},\"geometry\":{{\"type\":', {shape}, '}}}}')"
    return rows.selectExpr("n_regionkey", "n_nationkey", f"{one} AS f").groupBy("n_regionkey").agg(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "f"))), lambda s: s["f"])), F.lit("]}")).alias("value")
    )


@F.pandas_udf(BinaryType())
def _rectangles(west: pd.Series, east: pd.Series, south: pd.Series, north: pd.Series) -> pd.Series:
    """Rectangles in well-known binary."""
    return pd.Series([struct.pack("<BIII10d", 1, 3, 1, 5, w, s, e, s, e, n, w, n, w, s) for w, e, s, n in zip(west, east, south, north, strict=True)])


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rectangle of some metres for each order: geometry, height (the order), bbox, type (the partition)."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey AS double) AS height", "-58.5e0 + cast(o_orderkey % 1009 AS double) / 1000e0 AS xmin", "-34.9e0 + cast(o_orderkey % 503 AS double) / 1000e0 AS ymin",
        "cast(1 + o_orderkey % 12 AS double) / 100000e0 AS side", "CASE WHEN o_orderkey % 2 = 0 THEN 'building' ELSE 'part' END AS type",
    ).withColumn("xmax", F.col("xmin") + F.col("side")).withColumn("ymax", F.col("ymin") + F.col("side"))
    return rows.select(_rectangles("xmin", "xmax", "ymin", "ymax").alias("geometry"), "height", F.struct("xmin", "xmax", "ymin", "ymax").alias("bbox"), "type")


def populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, residenceId, jobId, size, one for each order: customers live at one point and work at another."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('pop_', lpad(cast(o_orderkey AS string), 8, '0')) AS id", "concat('p', o_custkey % 500) AS residenceId",
        "concat('p', (o_custkey * 7) % 500) AS jobId", "cast(o_orderkey % 200 AS bigint) + 1 AS size",
    )


RADIOS = """radios AS (SELECT c_custkey AS radio, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS area_id,
  -59.4e0 + 1.7e0 * CAST((c_custkey * 7919) % 10007 AS DOUBLE) / 10007e0 AS lon,
  -35.2e0 + CAST((c_custkey * 104729) % 10009 AS DOUBLE) / 10009e0 AS lat,
  CAST(floor(abs(c_acctbal) / 10e0) AS BIGINT) + 1 AS employed FROM customer)"""
ZONED = RADIOS + """, zoned AS (SELECT *, CAST(floor(lon / 0.2e0) AS BIGINT) AS zx, CAST(floor(lat / 0.2e0) AS BIGINT) AS zy FROM radios),
zones AS (SELECT CAST(row_number() OVER (ORDER BY zx, zy) - 1 AS BIGINT) AS zone, zx, zy, CAST(sum(employed) AS BIGINT) AS employed,
  count(*) AS radio_count, sum(lon * employed) / sum(employed) AS lon, sum(lat * employed) / sum(employed) AS lat FROM zoned GROUP BY zx, zy)"""
RAW = """raw AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS anio,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE -59.5e0 + CAST((o_orderkey * 31) % 190 AS DOUBLE) / 100e0 END AS longitude,
  -35.25e0 + CAST((o_orderkey * 17) % 110 AS DOUBLE) / 100e0 AS latitude,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'e. 500+' WHEN '2-HIGH' THEN 'd. 200-499' WHEN '3-MEDIUM' THEN 'c. 50-199'
    WHEN '4-NOT SPECIFIED' THEN 'b. 10-49' ELSE 'a. 1-9' END AS band FROM orders),
near AS (SELECT longitude, latitude, band FROM raw WHERE anio = 2000 AND longitude BETWEEN -59.4e0 AND -57.7e0 AND latitude BETWEEN -35.2e0 AND -34.2e0),
weighed AS (SELECT *, CASE band WHEN 'a. 1-9' THEN 5e0 WHEN 'b. 10-49' THEN 29.5e0 WHEN 'c. 50-199' THEN 124.5e0 WHEN 'd. 200-499' THEN 349.5e0 ELSE 500e0 END AS w FROM near)"""
WORKPLACES = RAW + """, places AS (SELECT CAST(row_number() OVER (ORDER BY longitude, latitude) - 1 AS BIGINT) AS n, * FROM
  (SELECT longitude, latitude, sum(w) AS employment_weight, count(*) AS establishments FROM weighed GROUP BY longitude, latitude))"""
POPS = """pops AS (SELECT concat('pop_', lpad(CAST(o_orderkey AS VARCHAR), 8, '0')) AS id, concat('p', o_custkey % 500) AS residence_id,
  concat('p', (o_custkey * 7) % 500) AS job_id, CAST(o_orderkey % 200 AS BIGINT) + 1 AS size FROM orders),
roles AS (SELECT residence_id AS point, id AS pop, size AS residents, 0 AS jobs, TRUE AS listed FROM pops
  UNION ALL SELECT job_id, id, 0, size, job_id <> residence_id FROM pops)"""
KM = "6371.0e0 * 2e0 * asin(sqrt(pow(sin((radians({b}.lat) - radians({a}.lat)) / 2e0), 2e0) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2e0), 2e0)))"
