"""What the text operators share: shared scratch space, row splits and batch plumbing."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import suppress
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, read by Spark alone so that any Hadoop path works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only where none is named and all executors are this process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='gravita-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


class Scratch:
    """Tables written under the shared folder to cut lineage: a lost executor costs a reread, not a recomputation.

    Every name is fresh, so concurrent calls and retries never meet. ``drop`` deletes a table that no
    later plan reads; the tables behind a returned DataFrame stay until the application's folder is cleaned.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/gravita-{label}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame, codec: str = "zstd", **options) -> DataFrame:
        self.count += 1
        path = f"{self.root}/t{self.count}"
        df.write.option("compression", codec).options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop_all(self, *but: DataFrame) -> None:
        """Delete all tables written here but those."""
        kept = {t.scratch_path for t in but}
        for i in range(1, self.count + 1):
            if (path := f"{self.root}/t{i}") not in kept:
                self._delete(path)

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            self._delete(t.scratch_path)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(scratch: Scratch, docs: DataFrame, name: str) -> DataFrame:
    """``docs``, written with a number of its own for each row, so that rows are told apart even where ids
    repeat or are null and every later read sees the same numbers."""
    return scratch.write(docs.withColumn(name, F.monotonically_increasing_id()))


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_sample(df: DataFrame, id_col: str, most: int) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of the id alone: the same rows at every partitioning.

    A hash threshold cuts the table to about twice the bound before the exact cut, so that no task
    holds or sends more than its share of the sample.
    """
    total = df.count()
    share = min(1.0, 2.0 * most / max(total, 1))
    rank = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30))
    picked = df.withColumn("_rank", rank).filter(F.col("_rank") < int(share * (1 << 30)) + 1)
    return picked.orderBy("_rank", id_col).limit(most).drop("_rank")


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def frugal(kernel: Callable) -> Callable:
    """A function of batches that hands unused memory back when its task ends: workers live on beside others."""

    @wraps(kernel)
    def run(batches):
        try:
            yield from kernel(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def texts(column: pa.Array) -> list[str]:
    """Whole texts of a batch; null counts as empty."""
    return ["" if t is None else t for t in column.to_pylist()]
