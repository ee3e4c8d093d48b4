"""Token ids as Parquet list columns.

Format, one folder: rows in ascending doc_id order over the files' names; columns doc_id, part (number
of the file's partition), at (ids before the document in its part), n_tokens, ids (list of int32, the
end id last). Ids are dictionary-encoded and bit-packed, the long columns delta-encoded; row groups and
pages are bounded, and every file carries page indexes, so that a reader of a few documents or of the
metadata alone opens only their pages.

Defined results: null text is empty and has the end id alone; whole texts are encoded, however long; rows
that repeat a doc_id stay, ordered among themselves by a hash of their texts; a null doc_id comes first;
partitions are cut inside a repeated id too; an empty table gives an empty folder; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, batch, frugal
from .tokens import library_encoder

END = 0
#: Bytes in a row group, bytes in a page, rows in a page.
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#at": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "512",
    "parquet.dictionary.page.size": str(1 << 20),
}
COLUMNS = "doc_id long, part int, at long, n_tokens long, ids array<int>"


def _encode(path: str, end: int):
    @frugal
    def run(batches):
        encoder, part, at = library_encoder(path), TaskContext.get().partitionId(), 0
        for b in batches:
            for first, ids, cuts in encoder.blocks(b.column("text")):
                ids, cuts = np.insert(ids, cuts[1:], end), cuts + np.arange(len(cuts))
                rows = len(cuts) - 1
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(first, rows), pa.array(np.full(rows, part, np.int32)), pa.array(at + cuts[:-1]), pa.array(np.diff(cuts)), lists],
                    names=["doc_id", "part", "at", "n_tokens", "ids"],
                )
                at += int(cuts[-1])

    return run


def token_rows(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """The rows to write: partitions follow one another in doc_id order, and so do the rows in each."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    order = ("doc_id", F.xxhash64("text"), F.col("_spread"))
    rows = rows.withColumn("_spread", F.monotonically_increasing_id())
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(_encode(path, end), COLUMNS)


def write_tokens(docs: DataFrame, folder: str, path: str, end: int = END, codec: str = "zstd") -> None:
    token_rows(docs, path, end).write.options(**LAYOUT).option("compression", codec).parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids. ``start`` is found from the small columns' pages alone."""
    rows = spark.read.schema(COLUMNS).parquet(folder)
    ends = rows.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("held"))
    before = F.coalesce(F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ends.select("part", before.alias("before"))
    return rows.join(starts, "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids")


def _digest(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("part", pa.int32()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for b in batches:
        lists = b.column("ids")
        ids, cuts = lists.flatten().to_numpy().astype("<u4"), lists.offsets.to_numpy().astype(np.int64)
        cuts = cuts - cuts[0]
        crc = [zlib.crc32(ids[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        yield batch(schema, b.column("doc_id"), b.column("at"), b.column("part"), np.diff(cuts), crc)


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, all from the files; the lists never leave their task."""
    rows = spark.read.schema(COLUMNS).parquet(folder)
    found = rows.select("doc_id", "at", "part", "ids").mapInArrow(_digest, "doc_id long, at long, part int, n_tokens long, ids_crc32 long")
    ends = rows.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("held"))
    before = F.coalesce(F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.join(ends.select("part", before.alias("before")), "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(spark: SparkSession, docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """Write the documents' ids in the format above, read them back, and digest what was read."""
    folder = f"{Scratch(spark, 'tokens').root}/ids"
    write_tokens(docs, folder, path, end)
    return token_digests(spark, folder)
