"""Sinks. Tasks write tables and documents; only small files of settings and archives are built on the driver."""

from __future__ import annotations

import hashlib
import json
import os
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .collections import Folder, write_document


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Header, fixed column order, quotes doubled."""
    df.select(*columns).write.mode("overwrite").csv(path, header=True, escape='"')


def _feature_lines(df: DataFrame) -> DataFrame:
    """Features as text, from columns type, coordinates (text) and properties."""
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'), F.to_json("properties"), F.lit(',"geometry":{"type":"'), F.col("type"),
        F.lit('","coordinates":'), F.col("coordinates"), F.lit("}}"),
    )
    return df.select(feature.alias("value"))


def write_features(df: DataFrame, path: str) -> None:
    """One GeoJSON feature a line."""
    _feature_lines(df).write.mode("overwrite").text(path)


def export_collection(df: DataFrame, path: str, marker: str, release: str, refresh: bool = True) -> bool:
    """One GeoJSON collection of the features, put in place whole, and a file beside it that names the
    release. Without ``refresh`` a file of the same release is used again. Says whether it was written. Tasks
    write the features; both files may lie on any file system that Spark reaches."""
    spark = df.sparkSession
    folder = Folder(spark)
    if not refresh and folder.exists(path) and (folder.text(marker) or "").strip() == release:
        return False
    write_document(spark, path, [('{"type":"FeatureCollection","features":[\n', _feature_lines(df))], "]}\n")
    folder.put(marker, [f"{release}\n"])
    return True


def write_layers(layers: dict[str, DataFrame], path: str) -> None:
    """A collection NAME.geojson for each layer of features in a folder."""
    for name, df in layers.items():
        write_document(df.sparkSession, f"{path}/{name}.geojson", [('{"type":"FeatureCollection","features":[\n', _feature_lines(df))], "]}\n")


def write_demand(points: DataFrame, pops: DataFrame, path: str, most: int) -> None:
    """The document of points and pops, in order of their ids; more than ``most`` pops are an error. Tasks write
    both, so neither has to fit the driver."""
    if pops.limit(most + 1).count() > most:
        raise ValueError(f"More than {most} populations")
    rows = lambda df: df.orderBy("id").select(F.to_json(F.struct("*")).alias("value"))
    write_document(points.sparkSession, path, [('{"points":[\n', rows(points)), ('],"pops":[\n', rows(pops))], "]}\n")


def replace_file(path: str, text: str) -> None:
    """Write beside the file and rename, so that readers see the old or the new one."""
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(f"{path}.part", path)


def patch_config(path: str, population: int, version: str) -> None:
    """Set two values of an existing JSON file; no file, no change."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        replace_file(path, json.dumps(said | {"population": population, "version": version}, indent=2, ensure_ascii=False) + "\n")


def pack_files(archive: str, folder: str, names: list[str], level: int = 9) -> str:
    """Zip files of a folder, write the digest beside it, and return the digest."""
    gone = [n for n in names if not os.path.isfile(os.path.join(folder, n))]
    if gone:
        raise FileNotFoundError("Missing package files: " + ", ".join(gone))
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED, compresslevel=level) as z:
        for n in names:
            z.write(os.path.join(folder, n), n)
    digest = hashlib.sha256()
    with open(archive, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    replace_file(f"{archive}.sha256", f"{digest.hexdigest()}  {os.path.basename(archive)}\n")
    return digest.hexdigest()


def file_digests(files: DataFrame) -> DataFrame:
    """sha256 of binary files (column content) as lower-case hex."""
    return files.withColumn("sha256", F.sha2("content", 256))
