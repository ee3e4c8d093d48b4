"""Readers. Every one states its schema; none infers it."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import little_endian
from ..operators.geometry import wkb_area
from .collections import read_features

FEATURES = "type string, crs string, features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
STATS = "area_id string, population double, jobs double"
AREAS = STATS + ", geometry string"
WORKPLACES = "workplace_id string, cell_id string, longitude double, latitude double, employment_weight double, establishments bigint"
RAW_COLUMNS = ("anio", "lat", "lon", "empleo")
#: Magic number and version of a building index.
INDEX_MAGIC, INDEX_VERSION = 0x49424253, 1


def features_of(documents: DataFrame, column: str = "value") -> DataFrame:
    """Features of GeoJSON collections held as text: ord, properties (null: empty map), type, coordinates
    (as text), srid."""
    parsed = documents.select(F.from_json(column, FEATURES).alias("d"))
    srid = F.coalesce(F.regexp_extract("d.crs", "EPSG:+([0-9]+)", 1), F.lit(""))
    rows = parsed.select(F.posexplode("d.features").alias("ord", "f"), F.nullif(srid, F.lit("")).cast("int").alias("srid"))
    empty = F.create_map().cast("map<string,string>")
    return rows.select("ord", F.coalesce("f.properties", empty).alias("properties"), "f.geometry.type", "f.geometry.coordinates", "srid")


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """The same of files, split over tasks by bytes: a file isn't read as one row. ``ord`` counts up over a file,
    not without gaps."""
    found, outside = read_features(spark, path)
    system = F.get_json_object("text", "$.crs")
    srid = F.nullif(F.regexp_extract(F.coalesce(system, F.lit("")), "EPSG:+([0-9]+)", 1), F.lit("")).cast("int")
    one = FEATURES[FEATURES.index("struct<") : -1]
    rows = found.select("file", F.col("place").alias("ord"), F.from_json("text", one).alias("f"))
    # One short row a file goes to the features, which stay where they were read.
    return rows.join(F.broadcast(outside.select("file", srid.alias("srid"))), "file").select(
        "ord", F.coalesce("f.properties", F.create_map().cast("map<string,string>")).alias("properties"), "f.geometry.type", "f.geometry.coordinates", "srid"
    )


def rings(features: DataFrame) -> DataFrame:
    """Adds ``rings``: the rings of a Polygon, or of all parts of a MultiPolygon."""
    single = F.from_json("coordinates", "array<array<array<double>>>")
    several = F.flatten(F.from_json("coordinates", "array<array<array<array<double>>>>"))
    return features.withColumn("rings", F.when(F.col("type") == "Polygon", single).when(F.col("type") == "MultiPolygon", several))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header and a known schema; quotes inside quotes are doubled."""
    return spark.read.csv(path, header=True, schema=schema, escape='"', multiLine=True)


def read_raw_workplaces(spark: SparkSession, path: str) -> DataFrame:
    """Raw establishments, all text; other columns are ignored, missing ones are an error."""
    df = spark.read.csv(path, header=True, escape='"')
    missing = sorted(set(RAW_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError("Workplace columns are missing: " + ", ".join(missing))
    return df.select(*RAW_COLUMNS)


def _events(text: str) -> list[tuple[str, str]]:
    """Start tags, end tags and texts of a page, in order."""
    seen: list[tuple[str, str]] = []
    parser = HTMLParser(convert_charrefs=True)
    parser.handle_starttag = lambda tag, attrs: seen.append(("open", tag))
    parser.handle_endtag = lambda tag: seen.append(("close", tag))
    parser.handle_data = lambda data: seen.append(("text", data))
    parser.feed(text)
    return seen


def table_rows(text: str) -> list[list[str]]:
    """Texts of the td cells of each table row, stripped. Only closed rows and cells count."""
    rows: list[list[str]] = []
    pending: list[str] = []
    begun = in_row = None
    for what, value in _events(text):
        match what, value:
            case "open", "tr":
                in_row, pending = True, []
            case "open", "td" if in_row:
                begun = ""
            case "text", data if begun is not None:
                begun += data
            case "close", "td" if in_row and begun is not None:
                pending, begun = [*pending, begun.strip()], None
            case "close", "tr" if in_row:
                rows.append(pending)
                in_row = None
    return rows


def html_rows(pages: DataFrame, key: str, column: str) -> DataFrame:
    """key, row, cells of every table row of a page, by a tolerant parser."""

    def run(batches):
        for b in batches:
            out = []
            for k, text in zip(b[key], b[column], strict=True):
                out += [(k, i, r) for i, r in enumerate(table_rows(text or ""))]
            yield pd.DataFrame(out, columns=[key, "row", "cells"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, column).mapInPandas(run, f"`{key}` {kind}, row int, cells array<string>")


def flat_html_rows(pages: DataFrame, key: str, column: str) -> DataFrame:
    """The same for flat tables without attributes or entities, by expressions alone."""
    rows = pages.select(key, F.posexplode(F.expr(f"regexp_extract_all(`{column}`, '<tr>(.*?)</tr>', 1)")).alias("row", "r"))
    return rows.select(key, "row", F.expr("transform(regexp_extract_all(r, '<td>(.*?)</td>', 1), c -> trim(c))").alias("cells"))


def stats_rows(rows: DataFrame) -> DataFrame:
    """area_id, population, jobs of table rows with six cells at least and a census id second."""
    ok = rows.filter((F.size("cells") >= 6) & F.element_at("cells", 2).rlike("^[0-9]{9}$"))
    number = lambda i: F.coalesce(F.nullif(F.regexp_replace(F.element_at("cells", i), "[^0-9]", ""), F.lit("")).cast("double"), F.lit(0.0))
    return ok.select(F.element_at("cells", 2).alias("area_id"), number(6).alias("population"), number(3).alias("jobs"))


def index_header(files: DataFrame) -> DataFrame:
    """count of binary building indexes (column content); a short, foreign or newer file is an error."""
    magic, version = little_endian(F.col("content"), 1, 4), little_endian(F.col("content"), 5, 1)
    ok = (F.octet_length("content") >= 12) & (magic == INDEX_MAGIC) & (version == INDEX_VERSION)
    count = little_endian(F.col("content"), 9, 4)
    return files.withColumn("count", F.when(ok, count).otherwise(F.raise_error(F.lit("not a building index")).cast("long")))


def read_footprints(spark: SparkSession, path: str, bbox, least_area: float | None = None) -> DataFrame:
    """geometry and height of footprints within a box, and of more than some square metres; the box test
    reaches the Parquet scan, the area is only taken of what passes it."""
    west, south, east, north = bbox
    b = F.col("bbox")
    rows = spark.read.parquet(path).filter((b.xmin >= west) & (b.xmax <= east) & (b.ymin >= south) & (b.ymax <= north))
    if least_area is not None:
        rows = rows.filter(wkb_area("geometry") > least_area)
    return rows.select("geometry", "height")
