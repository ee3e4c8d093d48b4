"""Exact deduplication with a heavy-hitter split.

Digests that hold a large share of the rows are found by mergeable Misra-Gries summaries, one bounded
summary a partition. Their exact winners are aggregated with map-side combining and broadcast, so that
rows of hot groups are decided where they are read. Only the remaining digests are shuffled, and none
of those can hold more than ``heavy_share`` of the rows.

Defined results: null text counts as empty; equal means identical after no change; of equal texts the
row with the largest doc_id stays; a null doc_id loses to any other; rows that repeat a doc_id count
one by one, and of those that share the largest doc_id any one stays, so each group keeps exactly one row;
whole texts are hashed, however long; an empty table gives an empty result; other columns, whatever their
names, are not read (``drop_exact_duplicates`` keeps them).
"""

from __future__ import annotations

import heapq
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, batch, frugal, numbered

#: Counters a summary may hold, and the share of all rows from which a digest counts as heavy.
COUNTERS = 1024
HEAVY_SHARE = 1 / 256
#: Logarithm of the bits that keys of groups are hashed to (8 MB).
BITS = 26
#: Column that tells rows apart while copies are dropped.
ROW = "_row"


def misra_gries(items, held: dict, counters: int) -> dict:
    """Add a block of items to a summary, and cut it back to ``counters`` entries.

    An item's count falls short of its frequency by at most rows / (counters + 1).
    """
    for item, n in Counter(items).items():
        held[item] = held.get(item, 0) + n
    if len(held) > counters:
        cut = heapq.nlargest(counters + 1, held.values())[-1]
        held = {item: n - cut for item, n in held.items() if n > cut}
    return held


def _summaries(counters: int):
    schema = pa.schema([("digest", pa.binary()), ("seen", pa.int64())])

    @frugal
    def run(batches):
        held: dict = {}
        for b in batches:
            held = misra_gries(b.column(0).to_pylist(), held, counters)
        yield batch(schema, list(held), list(held.values()))

    return run


def digests_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))


def heavy_digests(digests: DataFrame, counters: int = COUNTERS, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """Digests that may hold ``heavy_share`` of the rows: every one that does is here.

    Summed estimates never exceed the rows, so at most 1 / (heavy_share - 1 / (counters + 1)) pass.
    """
    total = digests.count()
    least = max(2.0, (heavy_share - 1 / (counters + 1)) * total)
    merged = digests.select("digest").mapInArrow(_summaries(counters), "digest binary, seen long")
    return merged.groupBy("digest").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= least).select("digest")


def exact_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    counters: int = COUNTERS,
    heavy_share: float = HEAVY_SHARE,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``docs``."""
    scratch = Scratch(spark, "exact")
    digests = numbered(scratch, digests_of(docs, id_col, text_col), ROW)
    heavy = heavy_digests(digests, counters, heavy_share)
    winners = (
        digests.join(F.broadcast(heavy), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", ROW)).alias("top"), F.count(F.lit(1)).alias("group_size"))
    )
    marked = digests.join(F.broadcast(winners.withColumn("hot", F.lit(True))), "digest", "left")
    group = Window.partitionBy("digest")
    light = (
        marked.filter(F.col("hot").isNull())
        .select("doc_id", ROW, "digest")
        .withColumn("top", F.max(F.struct("doc_id", ROW)).over(group))
        .withColumn("group_size", F.count(F.lit(1)).over(group))
    )
    rows = marked.filter(F.col("hot").isNotNull()).select("doc_id", ROW, "digest", "top", "group_size").unionByName(light)
    return rows.select(
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        "group_size",
        (F.col(ROW) == F.col(f"top.{ROW}")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def may_hold(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """``rows`` with a column ``maybe``, true wherever their key is in ``groups`` and seldom elsewhere: keys are hashed
    to bits, at most 2 ** BITS of them, and only the words of 64 bits that hold any are broadcast. Too many keys
    fill the words, and more rows are asked, but none is missed."""
    bits = 1 << min(BITS, max(12, (16 * groups.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    one = lambda at: F.expr(f"shiftleft(1L, cast({at} % 64 AS int))")
    words = groups.select(place(key).alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.bit_or(one("_at")).alias("_bits"))
    placed = rows.withColumn("_at", place(key)).withColumn("_word", F.shiftright("_at", 6))
    met = placed.join(F.broadcast(words), "_word", "left")  # at most 2 ** (BITS - 6) rows
    return met.withColumn("maybe", F.coalesce(F.col("_bits").bitwiseAND(one("_at")) != 0, F.lit(False))).drop("_at", "_word", "_bits")


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each text, with all its columns: the largest id, of rows that share it any
    one, and a row with a null id only where no other holds the text. Only digests are written; the rows are
    read again, and of those only the ones that may be in a group of several are shuffled to meet it."""
    scratch = Scratch(spark, "exact-rows")
    names = docs.columns
    plain = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = exact_duplicates(spark, plain).filter("group_size > 1")
    top = F.count_if(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    groups = scratch.write(found.groupBy("text_sha256").agg(F.first("keep_id").alias("keep_id"), top.alias("tied")))
    hashed = plain.select("row", "doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    asked = may_hold(hashed, groups, "text_sha256")
    marked = asked.filter("maybe").join(groups, "text_sha256", "left")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    kept = marked.filter(F.col("tied").isNull() | (first & (F.col("tied") == 1))).select("row")
    one = marked.filter((F.col("tied") > 1) & first).groupBy("text_sha256").agg(F.first("row").alias("row"))
    return asked.filter("NOT maybe").select("row").unionByName(kept).unionByName(one.select("row")).select("row.*")
