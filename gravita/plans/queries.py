"""Registered queries of the engine's own operators. Each name has, where SQL can say it, its SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import geo, scalar
from ..operators import allocate, checks, cluster, emit, geometry, gravity, overlay, prepare, report, spatial, tables
from ..sources import readers, writers
from . import demand, views
from .views import BBOX, KM, POPS, RADIOS, RAW, WEIGHTS, WORKPLACES, YEAR, ZONED, ZONE_DEGREES, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# Sources and sinks

_FEATURES = """feats AS (SELECT n_nationkey, n_regionkey, n_name, lpad(CAST(n_nationkey AS VARCHAR), 9, '0') AS area_id, -6600000 + n_nationkey * 12000 AS x,
  -4150000 + n_nationkey * 9000 AS y, CASE WHEN n_nationkey % 5 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS type FROM nation),
bounded AS (SELECT *, degrees(x / 6378137.0e0) AS west, degrees((x + 20000) / 6378137.0e0) AS east,
  degrees(2e0 * atan(exp(y / 6378137.0e0)) - pi() / 2e0) AS south, degrees(2e0 * atan(exp((y + 20000) / 6378137.0e0)) - pi() / 2e0) AS north FROM feats)"""


def _features(spark, sf_dir):
    return readers.features_of(views.features(spark, sf_dir))


@query(f"WITH {_FEATURES} SELECT area_id, n_name AS dpto, type FROM feats")
def geojson_scan(spark, sf_dir):
    return prepare.with_area_id(_features(spark, sf_dir)).select("area_id", F.col("properties")["dpto"].alias("dpto"), "type")


@query("SELECT o_orderkey, concat('}', o_orderstatus, '\"') AS status, round(CAST(o_orderkey % 1000 AS DOUBLE) / 8e0, 3) AS west, CAST(NULL AS INT) AS srid FROM orders")
def collection_round_trip(spark, sf_dir):
    """One collection of a feature for each order, written by all tasks and read by all tasks."""
    orders = table(spark, sf_dir, "orders")
    x = F.format_string("%.3f", F.col("o_orderkey") % 1000 / F.lit(8.0))
    ring = F.concat(F.lit("[[["), x, F.lit(",0],["), x, F.lit(",1],[0,1],["), x, F.lit(",0]]]"))
    status = F.concat(F.lit("}"), "o_orderstatus", F.lit('"'))
    properties = F.create_map(F.lit("id"), F.col("o_orderkey").cast("string"), F.lit("status"), status)
    folder = tables.shared_folder(spark)
    writers.write_layers({"orders": orders.select(F.lit("Polygon").alias("type"), ring.alias("coordinates"), properties.alias("properties"))}, folder)
    read = readers.rings(readers.read_geojson(spark, f"{folder}/orders.geojson"))
    return read.select(F.col("properties")["id"].cast("long").alias("o_orderkey"), F.col("properties")["status"].alias("status"), F.col("rings")[0][0][0].alias("west"), "srid")


def _html(spark, sf_dir):
    row = "concat('<tr><td>', n_name, '</td><td> ', lpad(cast(n_nationkey AS string), 9, '0'), '</td><td>', n_nationkey * 1000, '.5</td><td>-</td><td></td><td>1,', n_nationkey, '</td></tr><tr><td>Total</td></tr>')"
    return table(spark, sf_dir, "nation").selectExpr("cast(n_nationkey AS bigint) AS page", f"concat('<table><tr><th>x</th></tr>', {row}, '</table>') AS html")


_HTML_SQL = "SELECT lpad(CAST(n_nationkey AS VARCHAR), 9, '0') AS area_id, CAST(concat('1', n_nationkey) AS DOUBLE) AS population, CAST(concat(n_nationkey * 1000, '5') AS DOUBLE) AS jobs FROM nation"


@query(_HTML_SQL)
def html_table_extract(spark, sf_dir):
    return readers.stats_rows(readers.html_rows(_html(spark, sf_dir), "page", "html"))


@query(_HTML_SQL)
def html_table_extract_flat(spark, sf_dir):
    return readers.stats_rows(readers.flat_html_rows(_html(spark, sf_dir), "page", "html"))


@query("""SELECT page_id, row, cells FROM (SELECT page_id, page_id % 7 AS k, url FROM pages), LATERAL (VALUES
  (0, CAST(k AS VARCHAR) || '|a & b|' || url), (1, ''), (2, 'x<y'), (3, '0' || k || '|tail')) AS v(row, cells)""")
def html_rows_of_pages(spark, sf_dir):
    """Tables put into the pages: attributes, upper case, entities, header cells, nested marks, and a last row that
    is never closed and so doesn't count."""
    k, url = (F.col("page_id") % 7).cast("string"), F.col("url")
    rows = F.concat(
        F.lit("<TABLE class='x'><tr id=1><td> "), k, F.lit("\n</td><TD align=left>a &amp; b</TD><td><b>"), url, F.lit("</b></td></tr><tr><th>head</th></tr>"),
        F.lit("<tr><td>x&lt;y</td><!-- <td>no</td> --></tr><tr><td>&#48;"), k, F.lit("</td><td>tail</td></tr><tr><td>open</table>"),
    )
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.coalesce("html", F.lit("")), rows).alias("html"))
    return readers.html_rows(pages, "page_id", "html").select("page_id", "row", F.array_join("cells", "|").alias("cells"))


@query("SELECT o_orderkey, regexp_matches(tag, '^[0-9]{4}-[0-9]{2}-[0-9]{2}\\.[0-9]+$') AS ok FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE concat(strftime(o_orderdate, '%Y-%m-%d'), '.', o_orderkey % 10) END AS tag FROM orders)")
def release_tag_valid(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    tag = F.when(F.col("o_orderkey") % 3 == 0, day).otherwise(F.concat(day, F.lit("."), (F.col("o_orderkey") % 10).cast("string")))
    catalog = table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(tag.alias("latest"))).alias("catalog"))
    return catalog.select("o_orderkey", scalar.release_tag(F.get_json_object("catalog", "$.latest")).alias("ok"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT l_orderkey, l_linenumber, l_quantity AS height FROM lineitem WHERE l_quantity >= 10 AND l_quantity + 5 <= 40 AND l_suppkey >= 2 AND l_suppkey + 1 <= 60")
def footprint_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    box = F.struct(F.col("l_quantity").alias("xmin"), (F.col("l_quantity") + 5).alias("xmax"), F.col("l_suppkey").cast("double").alias("ymin"), (F.col("l_suppkey") + 1).cast("double").alias("ymax"))
    west, south, east, north = 10, 2, 40, 60
    b = rows.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("height"), box.alias("bbox"))
    return b.filter((F.col("bbox.xmin") >= west) & (F.col("bbox.xmax") <= east) & (F.col("bbox.ymin") >= south) & (F.col("bbox.ymax") <= north)).drop("bbox")


#: Half the squared semi-axis of WGS84 in square kilometres, its squared eccentricity and eccentricity.
_HALF_A2, _E2, _E = "20340315.793442745e0", "0.006694379990141316e0", "0.08181919084262149e0"


def _area_sql(west: str, east: str, south: str, north: str) -> str:
    """Square kilometres of a rectangle of longitudes and latitudes on the ellipsoid."""
    q = lambda lat: f"((1e0 - {_E2}) * (sin(radians({lat})) / (1e0 - {_E2} * pow(sin(radians({lat})), 2e0)) + ln((1e0 + {_E} * sin(radians({lat}))) / (1e0 - {_E} * sin(radians({lat})))) / (2e0 * {_E})))"
    return f"({_HALF_A2} * radians({east} - {west}) * ({q(north)} - {q(south)}))"


@query(f"""WITH f AS (SELECT o_orderkey, -58.5e0 + CAST(o_orderkey % 1009 AS DOUBLE) / 1000e0 AS xmin, -34.9e0 + CAST(o_orderkey % 503 AS DOUBLE) / 1000e0 AS ymin,
  CAST(1 + o_orderkey % 12 AS DOUBLE) / 100000e0 AS side FROM orders)
SELECT o_orderkey FROM f WHERE xmin >= -58.3e0 AND xmin + side <= -57.8e0 AND ymin >= -34.8e0 AND ymin + side <= -34.5e0 AND {_area_sql("xmin", "(xmin + side)", "ymin", "(ymin + side)")} > 0.00004e0""")
def footprint_scan(spark, sf_dir):
    """Footprints of more than 40 square metres in a box, read from partitioned Parquet."""
    path = f"{tables.shared_folder(spark)}/footprints"
    views.footprints(spark, sf_dir).write.partitionBy("type").parquet(path)
    return readers.read_footprints(spark, path, (-58.3, -34.8, -57.8, -34.5), 40.0).select(F.col("height").cast("long").alias("o_orderkey"))


def _headers(spark, sf_dir):
    little = lambda x, n: "unhex(concat(" + ", ".join(f"lpad(hex(shiftright({x}, {8 * i}) & 255), 2, '0')" for i in range(n)) + "))"
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS name", f"concat(unhex('53424249'), unhex('01000000'), {little('o_orderkey * 7', 4)}) AS content")


@query("SELECT o_orderkey AS name, o_orderkey * 7 AS count FROM orders")
def binary_header_decode(spark, sf_dir):
    return readers.index_header(_headers(spark, sf_dir)).select("name", "count")


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def file_digest(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    return writers.file_digests(files).select("doc_id", "sha256")


@query(f"WITH {RADIOS} SELECT area_id, CAST(employed AS DOUBLE) AS population, CAST(employed AS DOUBLE) AS jobs, concat('{{\"type\":\"Point\",\"coordinates\":[', radio, ',0]}}') AS geometry FROM radios")
def csv_roundtrip(spark, sf_dir):
    rows = views.radios(spark, sf_dir).select(
        "area_id", F.col("employed").cast("double").alias("population"), F.col("employed").cast("double").alias("jobs"),
        F.concat(F.lit('{"type":"Point","coordinates":['), F.col("radio").cast("string"), F.lit(",0]}")).alias("geometry"),
    )
    folder = f"{tables.shared_folder(spark)}/areas_csv"
    writers.write_csv(rows, folder, ["area_id", "population", "jobs", "geometry"])
    return readers.read_csv(spark, folder, readers.AREAS)


# Projections and filters


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE concat('id', n_nationkey) END AS area_id FROM nation")
def area_id_coalesce(spark, sf_dir):
    even = F.col("n_nationkey") % 2 == 0
    props = F.create_map(F.lit("area_id"), F.when(even, F.concat(F.lit(" "), "n_name")).otherwise(F.lit(" ")), F.lit("id"), F.concat(F.lit("id"), F.col("n_nationkey").cast("string")))
    return prepare.with_area_id(table(spark, sf_dir, "nation").select("n_nationkey", props.alias("properties"))).select("n_nationkey", "area_id")


@query("SELECT c_custkey, round(degrees(x / 6378137.0e0), 6) AS lon, round(degrees(2e0 * atan(exp(y / 6378137.0e0)) - pi() / 2e0), 6) AS lat FROM (SELECT c_custkey, -6600000e0 + c_custkey * 13e0 AS x, -4100000e0 - c_custkey * 7e0 AS y FROM customer)")
def mercator_to_wgs84(spark, sf_dir):
    x, y = F.lit(-6600000.0) + F.col("c_custkey") * F.lit(13.0), F.lit(-4100000.0) - F.col("c_custkey") * F.lit(7.0)
    p = geo.to_wgs84(F.array(F.array(F.array(x, y))))[0][0]
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(p[0], 6).alias("lon"), F.round(p[1], 6).alias("lat"))


@query(f"WITH {_FEATURES} SELECT area_id, round(west, 6) AS west, round(south, 6) AS south, round(east, 6) AS east, round(north, 6) AS north FROM bounded")
def geometry_bounds(spark, sf_dir):
    shaped = prepare.reprojected(readers.rings(prepare.with_area_id(_features(spark, sf_dir))))
    b = geo.bounds(F.col("rings"))
    return shaped.select("area_id", *(F.round(b[s], 6).alias(s) for s in ("west", "south", "east", "north")))


@query(f"WITH {_FEATURES} SELECT area_id, NOT (east < -59.0e0 OR west > -58.0e0 OR north < -34.9e0 OR south > -34.3e0) AS meets FROM bounded")
def bbox_overlap(spark, sf_dir):
    shaped = prepare.reprojected(readers.rings(prepare.with_area_id(_features(spark, sf_dir))))
    rows = shaped.withColumn("bounds", geo.bounds(F.col("rings")))
    return rows.select("area_id", geo.overlaps(F.col("bounds"), (-59.0, -34.9, -58.0, -34.3)).alias("meets"))


@query(f"WITH {_FEATURES} SELECT area_id, CAST(n_nationkey AS DOUBLE) * 10 + 1 AS population, CAST(n_nationkey AS DOUBLE) AS jobs FROM bounded WHERE n_nationkey % 7 <> 0 AND NOT (east < -59.4e0 OR west > -57.7e0 OR north < -35.2e0 OR south > -34.2e0)")
def prepare_census(spark, sf_dir):
    key = F.lpad(F.col("n_nationkey").cast("string"), 9, "0")
    base = table(spark, sf_dir, "nation").filter("n_nationkey % 7 <> 0")
    row = lambda i: base.select(F.concat(F.lit(" "), key).alias("area_id"), (F.col("n_nationkey") * 10.0 + i).alias("population"), F.col("n_nationkey").cast("double").alias("jobs"), F.lit(i).alias("ord"))
    return prepare.census_areas(_features(spark, sf_dir), row(0).unionByName(row(1)), BBOX).select("area_id", "population", "jobs")


@query(f"WITH {RAW} SELECT round(longitude, 6) AS longitude, round(latitude, 6) AS latitude, band FROM near")
def workplace_filter(spark, sf_dir):
    rows = prepare.filtered_workplaces(views.establishments(spark, sf_dir), YEAR, BBOX)
    return rows.select(F.round("longitude", 6).alias("longitude"), F.round("latitude", 6).alias("latitude"), "band")


@query(f"WITH {RAW} SELECT band, w AS employment_weight, count(*) AS n FROM weighed GROUP BY band, w")
def band_weight(spark, sf_dir):
    rows = prepare.weighted_workplaces(prepare.filtered_workplaces(views.establishments(spark, sf_dir), YEAR, BBOX), WEIGHTS)
    return rows.groupBy("band", "employment_weight").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {ZONED} SELECT radio, zx, zy FROM zoned")
def grid_bucket(spark, sf_dir):
    return cluster.zoned(views.radios(spark, sf_dir), ZONE_DEGREES).select("radio", "zx", "zy")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0e0 WHEN o_orderkey % 7 = 0 THEN 0e0 ELSE CAST(o_orderkey AS DOUBLE) END AS value FROM orders")
def coerce_numeric(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 5 == 0, F.lit("none")).when(F.col("o_orderkey") % 7 == 0, F.lit("NaN")).otherwise(F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t")).select("o_orderkey", scalar.coerced("t").alias("value"))


@query("SELECT o_orderkey, CAST(round_even(CAST(o_orderkey AS DOUBLE) / 2e0 - 100e0, 0) AS BIGINT) AS value FROM orders")
def half_even_round(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", scalar.half_even(F.col("o_orderkey").cast("double") / 2 - 100).alias("value"))


@query(f"WITH {RADIOS} SELECT a.radio, round({KM.format(a='a', b='b')}, 6) AS km FROM radios a JOIN radios b ON b.radio = (a.radio * 3 + 1) % (SELECT count(*) FROM radios)")
def haversine_km(spark, sf_dir):
    a = views.radios(spark, sf_dir)
    n = a.agg(F.count(F.lit(1)).alias("n"))
    b = a.select(F.col("radio").alias("other"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    met = tables.only_row(a, n).withColumn("other", (F.col("radio") * 3 + 1) % F.col("n")).join(b, "other")
    return met.select("radio", F.round(geo.haversine_km(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2")), 6).alias("km"))


@query("SELECT l_orderkey, l_linenumber, round(exp(-l_quantity / 12.0e0), 6) AS w FROM lineitem")
def gravity_weight(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(geo.gravity(F.col("l_quantity"), 12.0), 6).alias("w"))


@query("SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 35e0 * 3600e0, 0) AS BIGINT) AS seconds, CAST(round_even(l_quantity * 1000e0, 0) AS BIGINT) AS metres FROM lineitem")
def commute_metrics(spark, sf_dir):
    km = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", geo.driving_seconds(km).alias("seconds"), geo.driving_metres(km).alias("metres"))


@query("SELECT c_custkey, coalesce(TRY_CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT), 0) AS number, regexp_matches(lpad(CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 2 = 0 THEN 9 ELSE 8 END, '0'), '^[0-9]{9}$') AS is_id FROM customer")
def regex_clean(spark, sf_dir):
    key = F.when(F.col("c_custkey") % 2 == 0, F.lpad(F.col("c_custkey").cast("string"), 9, "0")).otherwise(F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
    return table(spark, sf_dir, "customer").select("c_custkey", scalar.digits(F.col("c_name")).alias("number"), scalar.census_id(key).alias("is_id"))


@query("SELECT c_custkey, least(greatest(c_acctbal, 0e0), 5000e0) AS clamped FROM customer")
def clamp_to_box(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", geo.clamp(F.col("c_acctbal"), 0.0, 5000.0).alias("clamped"))


# Joins


@query(f"WITH {_FEATURES} SELECT area_id FROM feats WHERE n_nationkey IN (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal > 0 AND c_nationkey % 2 = 1)")
def region_semi_join(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").filter("c_acctbal > 0 AND c_nationkey % 2 = 1").select(F.lpad(F.col("c_nationkey").cast("string"), 9, "0").alias("area_id"))
    shaped = readers.rings(prepare.with_area_id(_features(spark, sf_dir)))
    return prepare.wanted_features(shaped, wanted).select("area_id")


_NEAREST = f"""WITH {WORKPLACES}, {RADIOS}, clustered AS (SELECT *, radio % 50 AS cluster FROM radios),
s AS (SELECT cos(radians(avg(lat))) AS k FROM radios),
best AS (SELECT n, arg_min(radio, struct_pack(d := pow(p.longitude * k - r.lon * k, 2e0) + pow(p.latitude - r.lat, 2e0), i := radio)) AS radio FROM places p, radios r, s GROUP BY n),
caps AS (SELECT cluster, sum(establishments) AS capacity FROM best JOIN places USING (n) JOIN clustered USING (radio) GROUP BY cluster)
SELECT cluster, CAST(coalesce(capacity, 0) AS BIGINT) AS capacity FROM (SELECT DISTINCT cluster FROM clustered) LEFT JOIN caps USING (cluster)"""


@query(_NEAREST)
def nearest_radio_capacity(spark, sf_dir):
    places = _workplaces(spark, sf_dir).select(
        F.col("workplace_id").alias("workplace"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"), F.col("establishments").alias("capacity")
    )
    radios = views.radios(spark, sf_dir).select("radio", "lon", "lat", (F.col("radio") % 50).alias("cluster"))
    return spatial.capacity_by_cluster(places, radios, radios.select("cluster").distinct()).select("cluster", F.col("capacity").cast("long").alias("capacity"))


def _zones(spark, sf_dir):
    radios = cluster.zoned(views.radios(spark, sf_dir), ZONE_DEGREES)
    zones = cluster.zone_totals(radios)
    return zones.join(cluster.centroids(radios, ["zx", "zy"]).select("zx", "zy", "lon", "lat"), ["zx", "zy"])


def _graph(spark, sf_dir, k):
    zones = _zones(spark, sf_dir)
    return spatial.candidate_edges(zones.select(F.col("zone").alias("o"), "lon", "lat"), zones.select(F.col("zone").alias("d"), "lon", "lat"), k, 12.0)


def _graph_sql(k):
    return f"""WITH {ZONED}, dz AS (SELECT zone AS d, lon, lat FROM zones), s AS (SELECT cos(radians(avg(lat))) AS k FROM zones),
pairs AS (SELECT zone AS o, d, pow((z.lon - dz.lon) * k * 111.2e0, 2e0) + pow((z.lat - dz.lat) * 111.2e0, 2e0) AS d2, exp(-({KM.format(a='z', b='dz')}) / 12e0) AS w FROM zones z, dz, s),
near AS (SELECT o, d, w FROM pairs QUALIFY row_number() OVER (PARTITION BY d ORDER BY d2, o) <= {k}),
lost AS (SELECT o, d, w FROM pairs WHERE o NOT IN (SELECT o FROM near) QUALIFY row_number() OVER (PARTITION BY o ORDER BY d2, d) = 1),
edges AS (SELECT * FROM near UNION ALL SELECT * FROM lost)"""


@query(_graph_sql(10) + " SELECT o, d, round(w, 6) AS w FROM edges")
def knn_candidates(spark, sf_dir):
    return _graph(spark, sf_dir, 10).select("o", "d", F.round("w", 6).alias("w"))


@query(_graph_sql(1) + " SELECT o, d, round(w, 6) AS w FROM edges")
def knn_orphans(spark, sf_dir):
    return _graph(spark, sf_dir, 1).select("o", "d", F.round("w", 6).alias("w"))


_ALLOC = """a AS (SELECT l_suppkey % 20 AS g, l_linenumber * 100000 + l_orderkey % 300 AS a, CAST(sum(l_quantity) AS BIGINT) AS size FROM lineitem GROUP BY ALL),
b AS (SELECT l_suppkey % 20 AS g, l_partkey % 60 AS b, CAST(sum(l_quantity) AS BIGINT) AS size FROM lineitem GROUP BY ALL),
la AS (SELECT g, a, sum(size) OVER (PARTITION BY g ORDER BY size DESC, a) AS e1, size AS s FROM a),
lb AS (SELECT g, b, sum(size) OVER (PARTITION BY g ORDER BY size DESC, b) AS e2, size AS s FROM b)"""


@query(f"WITH {_ALLOC} SELECT g, a, b, CAST(least(e1, e2) - greatest(e1 - la.s, e2 - lb.s) AS BIGINT) AS size FROM la JOIN lb USING (g) WHERE e1 - la.s < e2 AND e2 - lb.s < e1")
def allocate_cell_flows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("g", F.col("l_suppkey") % 20)
    whole = F.sum("l_quantity").cast("long").alias("size")
    left = rows.groupBy("g", (F.col("l_linenumber").cast("long") * 100000 + F.col("l_orderkey") % 300).alias("a")).agg(whole)
    right = rows.groupBy("g", (F.col("l_partkey") % 60).alias("b")).agg(whole)
    return allocate.allocate(left, right, "g", "a", "b")


_DISAGG = """f AS (SELECT l_suppkey % 7 AS o, l_partkey % 5 AS d, CAST(sum(l_quantity) AS BIGINT) AS size FROM lineitem GROUP BY ALL),
oc AS (SELECT l_suppkey % 7 AS o, l_suppkey % 7 + 7 * (l_orderkey % 9) AS oc, CAST(sum(l_quantity) AS BIGINT) AS size FROM lineitem GROUP BY ALL),
dc AS (SELECT l_partkey % 5 AS d, l_partkey % 5 + 5 * (l_orderkey % 11) AS dc, CAST(sum(l_quantity) AS BIGINT) AS size FROM lineitem GROUP BY ALL),
l1 AS (SELECT o, oc, size, sum(size) OVER (PARTITION BY o ORDER BY size DESC, oc) AS e FROM oc), r1 AS (SELECT o, d, size, sum(size) OVER (PARTITION BY o ORDER BY size DESC, d) AS e FROM f),
seg AS (SELECT d, oc, least(l1.e, r1.e) - greatest(l1.e - l1.size, r1.e - r1.size) AS size FROM l1 JOIN r1 USING (o) WHERE l1.e - l1.size < r1.e AND r1.e - r1.size < l1.e),
l2 AS (SELECT d, oc, size, sum(size) OVER (PARTITION BY d ORDER BY size DESC, oc) AS e FROM seg), r2 AS (SELECT d, dc, size, sum(size) OVER (PARTITION BY d ORDER BY size DESC, dc) AS e FROM dc)"""


@query(f"WITH {_DISAGG} SELECT oc, dc, CAST(least(l2.e, r2.e) - greatest(l2.e - l2.size, r2.e - r2.size) AS BIGINT) AS size FROM l2 JOIN r2 USING (d) WHERE l2.e - l2.size < r2.e AND r2.e - r2.size < l2.e")
def disaggregate_flows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("o", F.col("l_suppkey") % 7).withColumn("d", F.col("l_partkey") % 5)
    whole = F.sum("l_quantity").cast("long").alias("size")
    return allocate.disaggregate(
        rows.groupBy("o", "d").agg(whole), rows.groupBy("o", (F.col("o") + 7 * (F.col("l_orderkey") % 9)).alias("oc")).agg(whole),
        rows.groupBy("d", (F.col("d") + 5 * (F.col("l_orderkey") % 11)).alias("dc")).agg(whole),
    )


@query("SELECT c_custkey % 300 / 10e0 AS lon, c_custkey % 7 / 10e0 AS lat, arg_min(concat('p', c_custkey), c_custkey) AS id FROM customer GROUP BY 1, 2")
def merge_points(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 300 / F.lit(10.0)).alias("lon"), (F.col("c_custkey") % 7 / F.lit(10.0)).alias("lat"),
        F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_custkey").alias("ord"),
    )
    return emit.merged_points(rows)


# Aggregations and order


def _workplaces(spark, sf_dir):
    return prepare.workplaces(views.establishments(spark, sf_dir), YEAR, BBOX, WEIGHTS, 0.005)


@query(f"""WITH {WORKPLACES} SELECT concat('work_', lpad(CAST(n AS VARCHAR), CAST(greatest(6, length(CAST(n AS VARCHAR))) AS INT), '0')) AS workplace_id,
  concat_ws('_', 'cell', CAST(floor(longitude / 0.005e0) AS BIGINT), CAST(floor(latitude / 0.005e0) AS BIGINT)) AS cell_id,
  round(longitude, 6) AS longitude, round(latitude, 6) AS latitude, employment_weight, establishments FROM places""")
def prepare_workplaces(spark, sf_dir):
    return _workplaces(spark, sf_dir).withColumn("longitude", F.round("longitude", 6)).withColumn("latitude", F.round("latitude", 6))


@query(f"WITH {ZONED} SELECT zone, zx, zy, employed, radio_count FROM zones")
def zone_totals(spark, sf_dir):
    return cluster.zone_totals(cluster.zoned(views.radios(spark, sf_dir), ZONE_DEGREES)).select("zone", "zx", "zy", "employed", "radio_count")


@query(f"WITH {ZONED} SELECT zone, round(lon, 6) AS lon, round(lat, 6) AS lat FROM zones")
def weighted_centroid(spark, sf_dir):
    return _zones(spark, sf_dir).select("zone", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("SELECT c_custkey, CAST(coalesce(s, 0) AS BIGINT) AS total FROM customer LEFT JOIN (SELECT o_custkey, sum(o_orderkey) AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def bincount_zero_fill(spark, sf_dir):
    facts = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return tables.zero_filled(table(spark, sf_dir, "customer"), facts, "c_custkey", "o_orderkey", "total")


@query("""SELECT region_id, coalesce(name, concat(CASE WHEN starts_with(region_id, '02') THEN 'Comuna ' ELSE 'Partido ' END, region_id)) AS name,
  CASE WHEN starts_with(region_id, '02') THEN 'comuna' ELSE 'partido' END AS region_type, population, jobs FROM
  (SELECT concat(CASE WHEN c_nationkey % 4 = 0 THEN '02' ELSE '06' END, lpad(CAST(c_nationkey AS VARCHAR), 3, '0')) AS region_id,
    CAST(sum(round_even(c_acctbal, 0)) AS BIGINT) AS population, CAST(sum(CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey END) AS BIGINT) AS jobs,
    arg_min(CASE WHEN n_nationkey % 6 <> 0 THEN n_name END, c_custkey) FILTER (WHERE n_nationkey % 6 <> 0) AS name
   FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)""")
def region_rollup(spark, sf_dir):
    both = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    prefix = F.when(F.col("c_nationkey") % 4 == 0, F.lit("02")).otherwise(F.lit("06"))
    areas = both.select(
        F.concat(prefix, F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.lpad(F.col("c_custkey").cast("string"), 4, "0")).alias("area_id"),
        F.col("c_acctbal").cast("string").alias("population"), F.when(F.col("c_custkey") % 3 == 0, F.lit("x")).otherwise(F.col("c_custkey").cast("string")).alias("jobs"),
        F.when(F.col("n_nationkey") % 6 != 0, F.col("n_name")).alias("name"), F.col("c_custkey").alias("ord"),
    )
    return prepare.region_rollup(areas)


_GRID = "SELECT CAST(s_suppkey AS BIGINT) AS k, s_suppkey % 10 AS x, s_suppkey // 10 AS y, s_nationkey % 3 AS region_id FROM supplier"


@query(f"""WITH cells AS ({_GRID}), sides AS (
  SELECT region_id, x AS x1, y AS y1, x + 1 AS x2, y AS y2 FROM cells UNION ALL SELECT region_id, x, y + 1, x + 1, y + 1 FROM cells
  UNION ALL SELECT region_id, x, y, x, y + 1 FROM cells UNION ALL SELECT region_id, x + 1, y, x + 1, y + 1 FROM cells)
SELECT CAST(region_id AS INT) AS region_id, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2 FROM sides GROUP BY ALL HAVING count(*) = 1""")
def dissolve_boundary(spark, sf_dir):
    return prepare.boundary_segments(_cells(spark, sf_dir))


def _cells(spark, sf_dir):
    x, y = (F.col("s_suppkey") % 10).cast("double"), F.floor(F.col("s_suppkey") / 10).cast("double")
    corner = lambda i, j: F.array(x + i, y + j)
    return table(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 3).alias("region_id"), F.array(F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1), corner(0, 0))).alias("rings"))


@query()
def dissolve_rings(spark, sf_dir):
    rows = geometry.stitched(prepare.boundary_segments(_cells(spark, sf_dir)))
    return rows.select("region_id", "ring", F.size("points").alias("n_points"))


@query(f"""WITH cells AS ({_GRID}), sides AS (
  SELECT region_id, x AS x1, y AS y1, x + 1 AS x2, y AS y2 FROM cells UNION ALL SELECT region_id, x, y + 1, x + 1, y + 1 FROM cells
  UNION ALL SELECT region_id, x, y, x, y + 1 FROM cells UNION ALL SELECT region_id, x + 1, y, x + 1, y + 1 FROM cells),
edges AS (SELECT * FROM sides GROUP BY ALL HAVING count(*) = 1)
SELECT CAST(region_id AS INT) AS region_id, count(*) AS segments, CAST(sum(x1 * 7 + y1 * 11 + x2 * 7 + y2 * 11) AS DOUBLE) AS places, true AS closed FROM edges GROUP BY region_id""")
def dissolve_closed(spark, sf_dir):
    """The rings of a region use every segment of its outline once, and end where they begin."""
    rows = geometry.stitched(prepare.boundary_segments(_cells(spark, sf_dir))).withColumn("steps", F.expr("transform(sequence(1, size(points) - 1), i -> struct(points[i - 1] as a, points[i] as b))"))
    places = F.aggregate("steps", F.lit(0.0), lambda acc, s: acc + (s["a"][0] + s["b"][0]) * 7 + (s["a"][1] + s["b"][1]) * 11)
    closed = F.element_at("points", 1) == F.element_at("points", -1)
    return rows.groupBy("region_id").agg(F.sum(F.size("steps")).alias("segments"), F.sum(places).alias("places"), F.bool_and(closed).alias("closed"))


@query("""WITH boxes AS (SELECT CAST(c_nationkey % 3 AS INT) AS region_id, c_custkey * 7919 % 181 AS x, c_custkey * 104729 % 97 AS y, 1 + c_custkey % 3 AS w, 1 + c_custkey % 2 AS h FROM customer),
filled AS (SELECT DISTINCT region_id, x, yy AS y FROM (SELECT region_id, x, unnest(range(y, y + h)) AS yy FROM (SELECT region_id, unnest(range(x, x + w)) AS x, y, h FROM boxes))),
sides AS (SELECT region_id, count(*) AS n FROM filled f, (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) AS d(a, b) WHERE NOT EXISTS (SELECT 1 FROM filled g WHERE g.region_id = f.region_id AND g.x = f.x + a AND g.y = f.y + b) GROUP BY region_id)
SELECT region_id, CAST(count(*) AS DOUBLE) / 4 AS area, CAST(max(n) AS DOUBLE) / 2 AS perimeter FROM filled JOIN sides USING (region_id) GROUP BY region_id""")
def dissolve_overlaps(spark, sf_dir):
    """Rectangles that overlap, touch along parts of their sides, and repeat, on a grid of halves."""
    k = F.col("c_custkey")
    x, y = (k * 7919 % 181) / 2, (k * 104729 % 97) / 2
    w, h = (1 + k % 3) / 2, (1 + k % 2) / 2
    corner = lambda a, b: F.array(x + a, y + b)
    zero = F.lit(0.0)
    ring = F.array(corner(zero, zero), corner(w, zero), corner(w, h), corner(zero, h), corner(zero, zero))
    areas = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 3).cast("int").alias("region_id"), F.array(F.array(ring)).alias("parts"))
    return overlay.measures(overlay.dissolved(areas)).select("region_id", F.round("area", 6).alias("area"), F.round("perimeter", 6).alias("perimeter"))


@query("WITH c AS (SELECT o_custkey AS k, o_orderkey AS n FROM orders) SELECT k, max(n) AS n FROM c GROUP BY k")
def dedupe_last_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("n"), F.col("o_orderkey").alias("ord"))
    return tables.last_wins(rows, "k", "ord")


@query("SELECT k, arg_max(v, ord) AS v FROM (SELECT c_custkey % 100 AS k, c_acctbal AS v, c_custkey AS ord FROM customer UNION ALL SELECT s_suppkey % 100, s_acctbal, 1000000000 + s_suppkey FROM supplier) GROUP BY k")
def union_dedupe(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 100).alias("k"), F.col("c_acctbal").alias("v"), F.col("c_custkey").alias("ord"))
    b = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 100).alias("k"), F.col("s_acctbal").alias("v"), (F.col("s_suppkey") + 1000000000).alias("ord"))
    return tables.last_wins(a.unionByName(b), "k", "ord")


@query("SELECT CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS BIGINT) AS n, o_orderkey FROM orders")
def enumerate_ids(spark, sf_dir):
    return tables.enumerate_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "n", F.desc("o_totalprice"), F.col("o_orderkey")).select("n", "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, concat('work_', CASE WHEN n < 1000000 THEN lpad(CAST(n AS VARCHAR), 6, '0') ELSE CAST(n AS VARCHAR) END) AS id FROM (SELECT l_orderkey, l_linenumber, CAST(l_orderkey * 100 + l_linenumber AS BIGINT) AS n FROM lineitem)")
def id_format(spark, sf_dir):
    """Ids on either side of their width; no two numbers share one."""
    n = (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("long")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scalar.padded("work_", 6, n).alias("id"))


@query("""WITH v AS (SELECT c_custkey, abs(c_acctbal) / 7e0 AS v FROM customer), s AS (SELECT CAST(round_even(sum(v), 0) AS BIGINT) - CAST(sum(floor(v)) AS BIGINT) AS extra FROM v)
SELECT c_custkey, CAST(floor(v) AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY v - floor(v) DESC, c_custkey) <= extra THEN 1 ELSE 0 END AS share FROM v, s""")
def integerize(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", (F.abs("c_acctbal") / 7).alias("v"))
    return tables.integerize(rows, "v", "c_custkey", "share").select("c_custkey", "share")


_BUDGET = "least(CAST((SELECT count(*) FROM radios) AS BIGINT), 4 * (SELECT count(*) FROM zones))"


def _budget(radios, zones):
    return radios.agg(F.count(F.lit(1)).alias("r")).crossJoin(zones.agg(F.count(F.lit(1)).alias("z"))).select(F.least(F.col("r"), F.col("z") * 4).alias("budget"))


@query(f"""WITH {ZONED}, seats AS (SELECT zone, employed, unnest(generate_series(2, radio_count)) AS seat FROM zones WHERE radio_count > 1),
won AS (SELECT zone, row_number() OVER (ORDER BY employed / CAST(seat AS DOUBLE) DESC, zone, seat) AS n FROM seats)
SELECT zones.zone, count(won.zone) + 1 AS clusters FROM zones LEFT JOIN won ON won.zone = zones.zone AND n <= {_BUDGET} - (SELECT count(*) FROM zones) GROUP BY zones.zone""")
def apportion_clusters(spark, sf_dir):
    radios = cluster.zoned(views.radios(spark, sf_dir), ZONE_DEGREES)
    zones = cluster.zone_totals(radios)
    return cluster.apportioned(zones, _budget(radios, zones))


@query()
def ward_clusters(spark, sf_dir):
    radios = cluster.zoned(views.radios(spark, sf_dir), ZONE_DEGREES)
    zones = tables.kept(cluster.zone_totals(radios))
    return cluster.ward_clusters(radios, zones, cluster.apportioned(zones, _budget(radios, zones)))


@query(f"""WITH {ZONED}, seats AS (SELECT zone, employed, unnest(generate_series(2, radio_count)) AS seat FROM zones WHERE radio_count > 1),
won AS (SELECT zone, row_number() OVER (ORDER BY employed / CAST(seat AS DOUBLE) DESC, zone, seat) AS n FROM seats)
SELECT zones.zone, zones.radio_count AS radios, count(won.zone) + 1 AS labels FROM zones LEFT JOIN won ON won.zone = zones.zone AND n <= {_BUDGET} - (SELECT count(*) FROM zones) GROUP BY ALL""")
def ward_sizes(spark, sf_dir):
    """Every radio has a label, and every zone as many labels as it was given."""
    return ward_clusters(spark, sf_dir).groupBy("zone").agg(F.count_distinct("radio").alias("radios"), F.count_distinct("label").alias("labels"))


@query("""WITH v AS (SELECT l_quantity AS v, CAST(l_linenumber AS BIGINT) AS w FROM lineitem), c AS (SELECT v, sum(sum(w)) OVER (ORDER BY v) AS upto FROM v GROUP BY v)
SELECT min(v) FILTER (WHERE upto >= 0.9e0 * (SELECT sum(w) FROM v)) AS p90 FROM c""")
def weighted_percentile(spark, sf_dir):
    return tables.weighted_percentile(table(spark, sf_dir, "lineitem"), "l_quantity", "l_linenumber", 0.9, "p90")


@query("""WITH v AS (SELECT l_quantity AS v, CAST(l_linenumber AS BIGINT) AS w FROM lineitem), c AS (SELECT v, sum(sum(w)) OVER (ORDER BY v) AS upto FROM v GROUP BY v), t AS (SELECT sum(w) AS t FROM v)
SELECT (SELECT round(sum(v * w) / sum(w), 6) FROM v) AS x_mean_km, min(v) FILTER (WHERE upto >= 0.5e0 * t) AS x_p50_km, min(v) FILTER (WHERE upto >= 0.9e0 * t) AS x_p90_km, max(v) AS x_max_km FROM c, t""")
def commute_figures(spark, sf_dir):
    flows = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("km"), F.col("l_linenumber").alias("w"))
    return report.commute_figures(flows, "w", "x").withColumn("x_mean_km", F.round("x_mean_km", 6))


@query("SELECT count(*) AS points, count(*) FILTER (WHERE o_orderkey % 3 > 0) AS job_points, count(*) FILTER (WHERE o_orderkey % 2 > 0) AS resident_points, count(*) - count(DISTINCT o_custkey) AS duplicate_coordinates FROM orders")
def output_counts(spark, sf_dir):
    points = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 3).alias("jobs"), (F.col("o_orderkey") % 2).alias("residents"), F.array(F.col("o_custkey").cast("double")).alias("location"))
    sizes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("size"))
    return report.output_figures(points, sizes).select("points", "job_points", "resident_points", "duplicate_coordinates")


@query("SELECT min(l_quantity) AS min, median(l_quantity) AS median, round(avg(l_quantity), 6) AS mean, quantile_cont(l_quantity, 0.9) AS p90, max(l_quantity) AS max FROM lineitem")
def size_distribution(spark, sf_dir):
    return tables.size_summary(table(spark, sf_dir, "lineitem"), "l_quantity").withColumn("mean", F.round("mean", 6))


@query(f"WITH {POPS} SELECT point, CAST(sum(residents) AS BIGINT) AS residents, CAST(sum(jobs) AS BIGINT) AS jobs FROM roles GROUP BY point")
def point_totals(spark, sf_dir):
    return emit.point_totals(views.populations(spark, sf_dir))


@query(f"WITH {POPS} SELECT point, string_agg(pop, ',' ORDER BY pop) AS pop_ids FROM roles WHERE listed GROUP BY point")
def point_pop_ids(spark, sf_dir):
    return emit.point_pop_ids(views.populations(spark, sf_dir)).select("point", F.concat_ws(",", "popIds").alias("pop_ids"))


# Iterative and numerical


@query("""WITH c AS (SELECT c_custkey AS cluster, CAST(floor(abs(c_acctbal)) AS BIGINT) AS employed, CAST(c_custkey % 90 AS BIGINT) AS capacity FROM customer),
t AS (SELECT sum(employed) AS e, least(sum(employed), sum(capacity)) AS f FROM c), v AS (SELECT cluster, employed, CAST(employed AS DOUBLE) * f / e AS v, f FROM c, t),
x AS (SELECT CAST(max(f) - sum(floor(v)) AS BIGINT) AS extra FROM v)
SELECT cluster, formal, employed - formal AS residual FROM (SELECT cluster, employed, CAST(floor(v) AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY v - floor(v) DESC, cluster) <= extra THEN 1 ELSE 0 END AS formal FROM v, x)""")
def formal_targets(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cluster"), F.floor(F.abs("c_acctbal")).cast("long").alias("employed"), (F.col("c_custkey") % 90).alias("capacity"))
    scaled = cluster.formal_targets(rows, rows)
    out = tables.integerize(scaled, "scaled", "cluster", "formal", scaled.agg(F.max("formal_total").alias("total")))
    return out.select("cluster", "formal", (F.col("employed") - F.col("formal")).alias("residual"))


_ROUND = """, a{i} AS (SELECT o, d, w * (CAST(1000 + o AS DOUBLE) / sum(w) OVER (PARTITION BY o)) AS w FROM {before}),
b{i} AS (SELECT o, d, w * (CAST(3000 + d AS DOUBLE) / sum(w) OVER (PARTITION BY d)) AS w FROM a{i})"""
_BALANCED = _graph_sql(10) + "".join(_ROUND.format(i=i, before="edges" if i == 0 else f"b{i - 1}") for i in range(3))


def _balanced(spark, sf_dir):
    edges = tables.kept(_graph(spark, sf_dir, 10))
    targets = lambda c, n: edges.select(c).distinct().withColumn("target", (F.col(c) + n).cast("double"))
    return gravity.balance_rounds(edges, targets("o", 1000), targets("d", 3000), 3), targets("o", 1000)


@query(_BALANCED + " SELECT o, d, round(w, 4) AS w FROM b2")
def ipf_balance(spark, sf_dir):
    return _balanced(spark, sf_dir)[0].select("o", "d", F.round("w", 4).alias("w"))


@query("SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice / 15) * 15 AS BIGINT) AS floor_flow FROM lineitem")
def flow_lower_bounds(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("w"))
    return gravity.lower_bounds(rows, 15, 16.0).select("l_orderkey", "l_linenumber", "floor_flow")


@query("SELECT l_orderkey, l_linenumber, CAST(ceil(l_extendedprice * 16) AS BIGINT) - CAST(floor(l_extendedprice / 15) * 15 AS BIGINT) AS capacity FROM lineitem")
def flow_capacities(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("w"))
    return gravity.lower_bounds(rows, 15, 16.0).select("l_orderkey", "l_linenumber", "capacity")


@query(_BALANCED + " SELECT o, d, round(-ln(greatest(w / CAST(1000 + o AS DOUBLE), 2.2250738585072014e-308)), 4) AS cost FROM b2")
def edge_costs(spark, sf_dir):
    flows, origins = _balanced(spark, sf_dir)
    return gravity.edge_costs(flows, origins).select("o", "d", F.round("cost", 4).alias("cost"))


def _transported(spark, sf_dir):
    edges = tables.kept(_graph(spark, sf_dir, 15))
    a = edges.select("o").distinct().withColumn("target", (100 + F.col("o") % 3).cast("long"))
    n = a.agg(F.sum("target").alias("total")).crossJoin(edges.agg(F.count_distinct("d").alias("n"), F.max("d").alias("last")))
    share = F.floor(F.col("total") / F.col("n"))
    b = tables.only_row(edges.select("d").distinct(), n).select("d", (share + F.when(F.col("d") == F.col("last"), F.col("total") - share * F.col("n")).otherwise(0)).cast("long").alias("target"))
    return gravity.transported(edges, a, b, 0.5, 2000, 16.0, 15), a, b


@query()
def transport(spark, sf_dir):
    """Balanced flows on whole numbers over the zones' graph; both margins are exact."""
    return _transported(spark, sf_dir)[0].select("o", "d", "size")


@query(f"WITH {ZONED} SELECT 'o' AS side, zone AS key, true AS met FROM zones UNION ALL SELECT 'd', zone, true FROM zones")
def balanced_margins(spark, sf_dir):
    """Proportional fitting goes on until every margin is within its tolerance."""
    flows, a, b = _transported(spark, sf_dir)
    flows = tables.kept(flows)

    def side(c, targets):
        both = flows.groupBy(c).agg(F.sum("w").alias("w")).join(targets, c)
        return both.select(F.lit(c).alias("side"), F.col(c).alias("key"), (F.abs(F.col("w") - F.col("target")) < 0.5).alias("met"))

    return side("o", a).unionByName(side("d", b))


@query(f"""WITH {ZONED}, n AS (SELECT count(*) AS n, sum(100 + zone % 3) AS total, max(zone) AS last FROM zones)
SELECT 'o' AS side, zone AS key, CAST(100 + zone % 3 AS BIGINT) AS size FROM zones UNION ALL
SELECT 'd', zone, CAST(total // n + CASE WHEN zone = last THEN total - total // n * n ELSE 0 END AS BIGINT) FROM zones, n""")
def transport_margins(spark, sf_dir):
    """What the whole flows add up to on either side: exactly the targets."""
    flows = tables.kept(transport(spark, sf_dir))
    side = lambda c: flows.groupBy(F.col(c).alias("key")).agg(F.sum("size").alias("size")).select(F.lit(c).alias("side"), "key", "size")
    return side("o").unionByName(side("d"))


@query("""WITH t AS (SELECT l_orderkey AS k, CAST(sum(l_quantity) AS BIGINT) AS t FROM lineitem GROUP BY 1), a AS (SELECT l_orderkey AS k, CAST(sum(l_quantity) AS BIGINT) AS a FROM lineitem WHERE l_orderkey % 10 <> 3 GROUP BY 1)
SELECT k, t AS target, coalesce(a, 0) AS assigned FROM t LEFT JOIN a USING (k) WHERE t <> coalesce(a, 0)""")
def check_margins(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").cast("long").alias("size"))
    return allocate.margin_errors(rows.filter("k % 10 <> 3"), rows.groupBy("k").agg(F.sum("size").alias("size")), "k")


@query(f"""WITH {ZONED}, c AS (SELECT zone, sum(radio % 4) AS capacity FROM zoned JOIN zones USING (zx, zy) WHERE zone % 5 <> 0 GROUP BY zone HAVING sum(radio % 4) > 0)
SELECT CAST(row_number() OVER (ORDER BY zone) - 1 AS BIGINT) AS d, concat('destination_zone_', zx, '_', zy) AS id, zone, CAST(capacity AS BIGINT) AS capacity FROM c JOIN zones USING (zone)""")
def destination_zones(spark, sf_dir):
    radios = cluster.zoned(views.radios(spark, sf_dir), ZONE_DEGREES)
    zones = _zones(spark, sf_dir).withColumn("id", F.concat_ws("_", F.lit("zone"), "zx", "zy"))
    members = radios.join(zones.select("zone", "zx", "zy"), ["zx", "zy"]).select(F.col("radio").alias("cluster"), "zone")
    held = members.select("cluster", F.when(F.col("zone") % 5 == 0, 0).otherwise(F.col("cluster") % 4).alias("capacity"))
    return cluster.destination_zones(members, held, zones).select("d", "id", "zone", "capacity")


@query("""WITH c AS (SELECT o_orderkey AS oc, o_custkey AS dc, CAST(floor(o_totalprice / 100) AS BIGINT) AS size FROM orders), parts AS (SELECT oc, dc, size, unnest(generate_series(0, CAST(ceil(size / 200e0) AS BIGINT) - 1)) AS part FROM c WHERE size > 0)
SELECT oc, dc, part, least(200, size - part * 200) AS chunk FROM parts""")
def population_chunks(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("oc"), F.col("o_custkey").alias("dc"), F.floor(F.col("o_totalprice") / 100).cast("long").alias("size"))
    return emit.chunks(rows, "size", 200).select("oc", "dc", "part", "chunk")


_EMIT = f"""WITH {RADIOS}, a AS (SELECT radio AS oc, (radio * 3) % (SELECT count(*) FROM radios) AS dc, employed AS size, 0 AS phase FROM radios UNION ALL SELECT radio, radio, employed // 2, 1 FROM radios),
p AS (SELECT oc, dc, size, phase, unnest(generate_series(0, CAST(ceil(size / 200e0) AS BIGINT) - 1)) AS part FROM a WHERE size > 0),
k AS (SELECT p.*, CASE WHEN phase = 1 THEN 0e0 ELSE {KM.format(a='h', b='j')} END AS km, row_number() OVER (ORDER BY phase, dc, oc, part) - 1 AS n FROM p JOIN radios h ON h.radio = oc JOIN radios j ON j.radio = dc)
SELECT concat('pop_', lpad(CAST(n AS VARCHAR), CAST(greatest(8, length(CAST(n AS VARCHAR))) AS INT), '0')) AS id, concat('r', oc) AS "residenceId", concat('r', dc) AS "jobId", CAST(round_even(km / 35e0 * 3600e0, 0) AS BIGINT) AS "drivingSeconds",
  CAST(round_even(km * 1000e0, 0) AS BIGINT) AS "drivingDistance", least(200, size - part * 200) AS size FROM k"""


@query(_EMIT)
def emit_populations(spark, sf_dir):
    radios = views.radios(spark, sf_dir)
    n = radios.agg(F.count(F.lit(1)).alias("n"))
    assigned = tables.only_row(radios, n).select(F.col("radio").alias("oc"), ((F.col("radio") * 3) % F.col("n")).alias("dc"), F.col("employed").alias("size"))
    residual = radios.select(F.col("radio").alias("oc"), F.floor(F.col("employed") / 2).cast("long").alias("size"))
    points = radios.select(F.col("radio").alias("cluster"), F.concat(F.lit("r"), F.col("radio").cast("string")).alias("id"), "lon", "lat")
    return emit.populations(assigned, residual, points, 200)


@query("SELECT n_nationkey, CAST(part AS INT) AS part, round(x, 5) AS x FROM (SELECT n_nationkey, unnest(CASE WHEN n_nationkey % 5 = 0 THEN [0, 1] ELSE [0] END) AS part, -6600000e0 + n_nationkey * 12000e0 AS x FROM nation)")
def explode_multipart(spark, sf_dir):
    rows = prepare.with_area_id(_features(spark, sf_dir))
    return prepare.single_parts(rows).select(F.col("area_id").cast("int").alias("n_nationkey"), "part", F.col("shape")[0][0][0].alias("x"))


@query("""WITH f AS (SELECT o_orderkey, 1 + o_orderkey % 12 AS side FROM orders) SELECT o_orderkey, 5 AS points FROM f WHERE side >= 7""")
def clean_buildings(spark, sf_dir):
    """Rectangles of 1 to 12 hundred-thousandths of a degree: those of more than 40 square metres keep their corners."""
    f = views.footprints(spark, sf_dir).select("height", "bbox.*")
    corner = lambda x, y: F.concat(F.lit("["), F.col(x), F.lit(","), F.col(y), F.lit("]"))
    ring = F.concat_ws(",", corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"), corner("xmin", "ymin"))
    f = f.repartition(spark.sparkContext.defaultParallelism)  # the table is one small file
    features = f.select(F.col("height").cast("long").alias("o_orderkey"), F.lit("Polygon").alias("type"), F.concat(F.lit("[["), ring, F.lit("]]")).alias("coordinates"))
    found = prepare.cleaned_buildings(features, -57.0, 40.0, snap=0.01)
    return found.select("o_orderkey", F.size(F.col("shape")[0]).alias("points"))


@query(f"WITH {_FEATURES} SELECT area_id, round((west + east) / 2e0, 6) AS lon, round((south + north) / 2e0, 6) AS lat FROM bounded")
def representative_point(spark, sf_dir):
    shaped = prepare.reprojected(readers.rings(prepare.with_area_id(_features(spark, sf_dir))))
    return shaped.select("area_id", geometry.interior_point("rings").alias("p")).select("area_id", F.round("p.lon", 6).alias("lon"), F.round("p.lat", 6).alias("lat"))


@query(f"WITH {_FEATURES} SELECT area_id, round({_area_sql('west', 'east', 'south', 'north')} * CASE type WHEN 'Polygon' THEN 1 ELSE 2 END, 5) AS square_kilometres FROM bounded")
def footprint_area(spark, sf_dir):
    shaped = prepare.reprojected(readers.rings(prepare.with_area_id(_features(spark, sf_dir))))
    return shaped.select("area_id", F.round(geometry.spheroid_area("rings") / 1e6, 5).alias("square_kilometres"))


@query(f"WITH {_FEATURES} SELECT area_id, CASE type WHEN 'Polygon' THEN 5 ELSE 10 END AS n_points FROM feats")
def simplify_outline(spark, sf_dir):
    shaped = prepare.reprojected(readers.rings(prepare.with_area_id(_features(spark, sf_dir))))
    return shaped.select("area_id", F.size(F.flatten(geometry.simplified("rings", 0.00001))).alias("n_points"))


@query("""WITH o AS (SELECT o_orderkey, 10 + o_orderkey % 20 AS s, (o_orderkey % 9) / 8e0 AS bulge, (o_orderkey % 7) / 8e0 AS dent FROM orders),
p AS (SELECT o_orderkey, unnest([{'n': 0, 'x': 0e0, 'y': 0e0, 'k': true}, {'n': 1, 'x': CAST(s AS DOUBLE), 'y': -bulge, 'k': bulge > 0.5e0}, {'n': 2, 'x': 2e0 * s, 'y': 0e0, 'k': true},
  {'n': 3, 'x': 2e0 * s, 'y': CAST(s AS DOUBLE), 'k': true}, {'n': 4, 'x': 1.5e0 * s, 'y': s - dent, 'k': dent > 0.5e0}, {'n': 5, 'x': CAST(s AS DOUBLE), 'y': CAST(s AS DOUBLE), 'k': true},
  {'n': 6, 'x': CAST(s AS DOUBLE), 'y': 3e0 * s, 'k': true}, {'n': 7, 'x': 0e0, 'y': 3e0 * s, 'k': true}, {'n': 8, 'x': 0e0, 'y': 0e0, 'k': true}]) AS v FROM o)
SELECT o_orderkey, count(*) AS points, sum(v.x * (v.n + 1)) AS xs, sum(v.y * (v.n + 1)) AS ys FROM p WHERE v.k GROUP BY o_orderkey""")
def simplify_vertices(spark, sf_dir):
    """L-shaped outlines with a bulge and a dent, which stay if they are deeper than half a unit; places are told by
    sums over the points and their numbers."""
    k = F.col("o_orderkey")
    size, bulge, dent = (10 + k % 20).cast("double"), (k % 9) / 8, (k % 7) / 8
    zero = F.lit(0.0)
    corners = [(zero, zero), (size, -bulge), (2 * size, zero), (2 * size, size), (1.5 * size, size - dent), (size, size), (size, 3 * size), (zero, 3 * size), (zero, zero)]
    ring = F.array(*(F.array(x, y) for x, y in corners))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", ring.alias("ring")).withColumn("rings", F.array("ring"))
    thin = rows.withColumn("thin", geometry.simplified("rings", 0.5)[0])
    number = lambda p: F.array_position(F.slice("ring", 1, 8), p).cast("double")
    place = lambda p, i: F.when((i == F.size("thin") - 1), F.lit(9.0)).otherwise(number(p))
    total = lambda c: F.aggregate(F.transform("thin", lambda p, i: p[c] * place(p, i)), F.lit(0.0), lambda a, x: a + x)
    return thin.select("o_orderkey", F.size("thin").cast("long").alias("points"), total(0).alias("xs"), total(1).alias("ys"))


# Validation


def _points(spark, sf_dir):
    """Consistent points of the test populations: id, lon, lat, jobs, residents, popIds."""
    pops = views.populations(spark, sf_dir)
    sums = emit.point_totals(pops).join(emit.point_pop_ids(pops), "point")
    number = F.substring("point", 2, 10).cast("double")
    return sums.select(F.col("point").alias("id"), (-59.4 + number / 400).alias("lon"), (-35.2 + number / 600).alias("lat"), "jobs", "residents", "popIds")



@query("SELECT 'bbox' AS rule, n_name AS offender FROM nation WHERE n_nationkey % 3 <> 0")
def check_bbox(spark, sf_dir):
    key = F.col("n_nationkey") % 3
    good, flipped, short = (F.array(*(F.lit(float(x)) for x in v)) for v in ((-1, -1, 1, 1), (1, -1, -1, 1), (-1, -1, 1)))
    return checks.bbox(table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.when(key == 0, good).when(key == 1, flipped).otherwise(short).alias("bbox")))


@query("SELECT 'points_empty' AS rule, '0' AS offender")
def check_nonempty(spark, sf_dir):
    return checks.count_between(table(spark, sf_dir, "region").filter("r_regionkey > 99"), "points_empty", least=1)


@query("SELECT 'budget' AS rule, CAST(count(*) AS VARCHAR) AS offender FROM orders")
def check_budget(spark, sf_dir):
    return checks.count_between(table(spark, sf_dir, "orders"), "budget", most=1000)


@query("SELECT 'point_count' AS rule, '25' AS offender")
def check_point_count(spark, sf_dir):
    return checks.count_between(table(spark, sf_dir, "nation"), "point_count", least=24, most=24)


@query("SELECT 'coordinates' AS rule, concat_ws(',', c_nationkey, c_mktsegment) AS offender FROM customer GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 1")
def check_duplicates(spark, sf_dir):
    return checks.unique(table(spark, sf_dir, "customer"), "coordinates", "c_nationkey", "c_mktsegment")


@query(f"WITH {POPS} SELECT DISTINCT 'references' AS rule, pop AS offender FROM roles WHERE CAST(substr(point, 2) AS INT) % 50 = 7")
def check_refs(spark, sf_dir):
    points = _points(spark, sf_dir).filter("cast(substring(id, 2, 10) AS int) % 50 <> 7")
    return checks.references(points, views.populations(spark, sf_dir))


@query("SELECT 'job_locations' AS rule, '3.0,0.5' AS offender")
def check_job_locations(spark, sf_dir):
    points = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("double").alias("lon"), F.lit(0.5).alias("lat"), (F.col("n_nationkey") % 3 == 0).cast("int").alias("jobs"))
    return checks.job_locations(points, points.filter("lon <> 3 AND lon <> 9"))


@query(f"WITH {POPS} SELECT 'sizes' AS rule, id AS offender FROM pops WHERE size > 190")
def check_sizes(spark, sf_dir):
    return checks.sizes(views.populations(spark, sf_dir), 190)


@query(f"WITH {RADIOS} SELECT 'in_bbox' AS rule, area_id AS offender FROM radios WHERE NOT (lon BETWEEN -59e0 AND -58e0 AND lat BETWEEN -35e0 AND -34.5e0)")
def check_in_bbox(spark, sf_dir):
    return checks.in_bbox(views.radios(spark, sf_dir).withColumnRenamed("area_id", "id"), (-59.0, -35.0, -58.0, -34.5))


@query(f"WITH {POPS} SELECT DISTINCT 'pop_ids' AS rule, point AS offender FROM roles WHERE listed AND CAST(substr(point, 2) AS INT) % 40 IN (3, 5)")
def check_pop_ids(spark, sf_dir):
    at = F.substring("id", 2, 10).cast("int") % 40
    changed = F.when(at == 3, F.array_append("popIds", "pop_x")).when(at == 5, F.array_append("popIds", F.col("popIds")[0])).otherwise(F.col("popIds"))
    return checks.pop_ids(_points(spark, sf_dir).withColumn("popIds", changed), views.populations(spark, sf_dir))


@query(f"WITH {POPS} SELECT DISTINCT 'point_totals' AS rule, point AS offender FROM roles WHERE CAST(substr(point, 2) AS INT) % 40 = 3")
def check_point_totals(spark, sf_dir):
    changed = F.col("jobs") + F.when(F.substring("id", 2, 10).cast("int") % 40 == 3, 1).otherwise(0)
    return checks.point_sums(_points(spark, sf_dir).withColumn("jobs", changed), views.populations(spark, sf_dir))


@query(f"WITH {POPS} SELECT 'global_totals' AS rule, concat_ws(',', sum(residents), sum(jobs), sum(residents)) AS offender FROM roles")
def check_global_totals(spark, sf_dir):
    return checks.global_sums(_points(spark, sf_dir), views.populations(spark, sf_dir), -1)


@query("SELECT 'report' AS rule, unnest(['density', 'mean_drift', 'p90_drift', 'points', 'populations']) AS offender")
def check_report(spark, sf_dir):
    figures = table(spark, sf_dir, "nation").agg(
        F.lit(0).alias("duplicate_coordinates"), F.count(F.lit(1)).alias("points"), F.lit(1001).alias("populations"), F.lit(9).alias("solver_zones"),
        F.lit(12.0).alias("dense_formal_mean_km"), F.lit(14.1).alias("exported_formal_mean_km"), F.lit(22.0).alias("dense_formal_p90_km"), F.lit(None).cast("double").alias("exported_formal_p90_km"),
    )
    return checks.report(figures, 1000, 26)


@query("SELECT 'building_index' AS rule, CAST(o_orderkey AS VARCHAR) AS offender FROM orders WHERE o_orderkey % 5 = 1 OR o_orderkey * 7 <= 100")
def check_building_index(spark, sf_dir):
    files = _headers(spark, sf_dir)
    stated = F.col("o_orderkey") * 7 + F.when(F.col("o_orderkey") % 5 == 1, 1).otherwise(0)
    described = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("name"), F.concat(F.lit('{"stats":{"count":'), stated.cast("string"), F.lit("}}")).alias("json"))
    return checks.building_index(described, files, 100)


@query("SELECT 'package' AS rule, 'ABC' AS offender")
def check_package(spark, sf_dir):
    files = table(spark, sf_dir, "nation").select(F.lit("ABC").alias("code"), F.concat("n_name", F.lit(".pmtiles")).alias("name"))
    return checks.package(files, "ABC", "XYZ.")


@query("SELECT 'required_files' AS rule, n_name AS offender FROM nation WHERE n_nationkey % 4 = 1")
def check_required_files(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    return checks.required_files(names.filter("n_nationkey % 4 <> 1"), names)


@query("SELECT 'config_code' AS rule, CASE WHEN n_nationkey % 3 = 1 THEN 'XYZ' ELSE '' END AS offender FROM nation WHERE n_nationkey % 3 > 0")
def check_config_code(spark, sf_dir):
    key = F.col("n_nationkey") % 3
    said = F.when(key == 0, F.lit('{"code":"ABC"}')).when(key == 1, F.lit('{"code":"XYZ"}')).otherwise(F.lit("{}"))
    return checks.config_code(table(spark, sf_dir, "nation").select(said.alias("json")), "ABC")


def _broken_document(spark, sf_dir) -> checks.Document:
    """With faults of many kinds."""
    n = F.substring("id", 2, 10).cast("int")
    points = tables.kept(_points(spark, sf_dir)).filter(n % 50 != 7)
    moved = lambda c, to: F.when(n.isin(11, 12), F.lit(to)).otherwise(F.col(c)).alias(c)
    changed = F.when(n % 40 == 5, F.array_append("popIds", F.col("popIds")[0])).otherwise(F.col("popIds"))
    points = points.select("id", moved("lon", -59.0), moved("lat", -35.0), (F.col("jobs") + F.when(n % 40 == 3, 1).otherwise(0)).alias("jobs"), "residents", changed.alias("popIds"))
    allowed = points.select("lon", "lat").filter("lon <> -59.0")
    names = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    configs = names.select(F.when(F.col("n_nationkey") % 3 == 1, F.lit('{"code":"XYZ"}')).otherwise(F.lit('{"code":"ABC"}')).alias("json"))
    more = checks.config_code(configs, "ABC"), checks.required_files(names.filter("n_nationkey % 4 <> 1"), names)
    return checks.Document(points, views.populations(spark, sf_dir), (-59.5, -35.3, -58.8999, -34.0), 190, 1000, -1, 7, allowed, more)


@query(f"""WITH {POPS}, p AS (SELECT point, CAST(substr(point, 2) AS INT) AS n, sum(residents) AS residents, sum(jobs) + CASE WHEN CAST(substr(point, 2) AS INT) % 40 = 3 THEN 1 ELSE 0 END AS jobs
  FROM roles GROUP BY point HAVING CAST(substr(point, 2) AS INT) % 50 <> 7),
t AS (SELECT concat_ws(',', (SELECT sum(residents) FROM p), (SELECT sum(jobs) FROM p), (SELECT sum(size) FROM pops)) AS sums)
SELECT 'budget' AS rule, CAST(count(*) AS VARCHAR) AS offender FROM orders
UNION ALL SELECT 'point_count', CAST(count(*) AS VARCHAR) FROM p
UNION ALL SELECT 'coordinates', '-59.0,-35.0' FROM p WHERE n IN (11, 12) HAVING count(*) > 1
UNION ALL SELECT 'job_locations', '-59.0,-35.0' FROM p WHERE n IN (11, 12) AND jobs > 0 HAVING count(*) > 0
UNION ALL SELECT DISTINCT 'references', pop FROM roles WHERE CAST(substr(point, 2) AS INT) % 50 = 7
UNION ALL SELECT 'sizes', id FROM pops WHERE size > 190
UNION ALL SELECT 'in_bbox', point FROM p WHERE n > 200 AND n NOT IN (11, 12)
UNION ALL SELECT DISTINCT 'pop_ids', point FROM roles WHERE listed AND CAST(substr(point, 2) AS INT) % 40 = 5 AND CAST(substr(point, 2) AS INT) % 50 <> 7
UNION ALL SELECT 'point_totals', point FROM p WHERE n % 40 = 3
UNION ALL SELECT 'global_totals', sums FROM t
UNION ALL SELECT 'config_code', 'XYZ' FROM nation WHERE n_nationkey % 3 = 1
UNION ALL SELECT 'required_files', n_name FROM nation WHERE n_nationkey % 4 = 1""")
def validate_document(spark, sf_dir):
    """Every broken rule's offenders; rules that hold give none."""
    return _broken_document(spark, sf_dir).offenders().select("rule", "offender")


@query(f"""WITH {POPS}, p AS (SELECT DISTINCT point, CAST(substr(point, 2) AS INT) AS n FROM roles)
SELECT 'references' AS rule, count(*) AS broken FROM p WHERE n % 50 = 7 UNION ALL SELECT 'sizes', count(*) FROM pops WHERE size > 190
UNION ALL SELECT 'in_bbox', count(*) FROM p WHERE n % 50 <> 7 AND n > 200 AND n NOT IN (11, 12)
UNION ALL SELECT 'pop_ids', count(*) FROM p WHERE n % 50 <> 7 AND n % 40 = 5 UNION ALL SELECT 'point_totals', count(*) FROM p WHERE n % 50 <> 7 AND n % 40 = 3
UNION ALL SELECT unnest(['budget', 'point_count', 'global_totals']), 1 UNION ALL SELECT unnest(['points_empty', 'pops_empty']), 0""")
def validate_counts(spark, sf_dir):
    """What the job that reads both tables once says of each rule that it covers."""
    return spark.createDataFrame(sorted(_broken_document(spark, sf_dir).counted().items()), "rule string, broken long")


# Whole runs


def _model(spark, sf_dir) -> demand.Demand:
    radios = views.radios(spark, sf_dir)
    zones = cluster.zone_totals(cluster.zoned(radios, ZONE_DEGREES))
    places = _workplaces(spark, sf_dir).select(F.col("workplace_id").alias("workplace"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"), (F.col("employment_weight") / 20).alias("employment_weight"))
    return demand.build(radios, places, Config(solver_zone_degrees=ZONE_DEGREES), _budget(radios, zones))


@query()
def demand_points(spark, sf_dir):
    return _model(spark, sf_dir).points


@query()
def demand_populations(spark, sf_dir):
    return _model(spark, sf_dir).pops


@query(f"WITH {RADIOS} SELECT CAST(sum(employed) AS BIGINT) AS residents, CAST(sum(employed) AS BIGINT) AS jobs, CAST(sum(employed) AS BIGINT) AS people, 0::BIGINT AS strangers FROM radios")
def demand_totals(spark, sf_dir):
    """Everyone lives at a point, works at a point and belongs to a population of known points."""
    model = _model(spark, sf_dir)
    sums = model.points.agg(F.sum("residents").alias("residents"), F.sum("jobs").alias("jobs")).crossJoin(model.pops.agg(F.sum("size").alias("people")))
    known = model.points.select("id")
    strangers = model.pops.join(known.withColumnRenamed("id", "residenceId"), "residenceId", "left_anti").agg(F.count(F.lit(1)).alias("strangers"))
    return sums.crossJoin(strangers)


@query()
def demand_report(spark, sf_dir):
    return _model(spark, sf_dir).report
