"""General steps: enumeration, exact integer shares, ordered percentiles, deduplication."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Stretches that a pass over a range counts.
BUCKETS = 4096


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one that all executors share; one of our own only where none is named and all
    executors are this process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='gravita-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/gravita-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder: later plans read them instead of holding how they came about,
    and a lost executor takes nothing with it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def some(df: DataFrame, message: str) -> DataFrame:
    """The rows, written as ``kept`` does; an error where there are none."""
    found = kept(df)
    if found.isEmpty():
        raise ValueError(message)
    return found


def only_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """Every row beside the one row of an ungrouped aggregate, which is broadcast."""
    return df.crossJoin(F.broadcast(one))


def enumerate_rows(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """Dense numbers from 0 in a total order. Rows are sorted over all partitions and numbered there;
    only the partitions' counts meet in one place. The sorted rows are written with their places, since both
    passes must see the same ones."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumn("_mid", F.monotonically_increasing_id())
    placed = kept(placed)
    part, at = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_part", before.alias("_before"))
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(name, (F.col("_before") + at).cast("long")).drop("_mid", "_part", "_before")


def running_sum(df: DataFrame, value: str, out: str, *order: Column | str) -> DataFrame:
    """Sum of ``value`` up to and with each row in a total order. Rows are sorted over all partitions and
    summed within theirs; only the partitions' sums meet in one place."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = kept(placed.withColumn("_mid", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_mid", 33))
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("_part", before.alias("_before"))
    own = F.sum(value).over(Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn(out, own).join(F.broadcast(starts), "_part").withColumn(out, F.col("_before") + F.col(out)).drop("_mid", "_part", "_before")


def number_rows(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """The same for tables bounded by the model (zones, clusters): one sorted window."""
    return df.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))


def integerize(df: DataFrame, value: str, index: str, out: str, total: DataFrame | None = None) -> DataFrame:
    """Whole numbers nearest to ``value`` with the exact sum ``total`` (a one-row table with column total;
    by default the half-even rounded sum, taken of decimals so that it doesn't depend on the rows' order).
    The largest fractions get the ones that are left, ties by smaller index: rows are numbered in that order
    over all partitions, and the first ones get one more."""
    floor, rest = F.floor(value).cast("long"), F.col(value) - F.floor(value)
    rows = df.withColumn("_floor", floor).withColumn("_rest", rest)
    exact = F.sum(F.col(value).cast("decimal(38,12)"))
    sums = rows.agg(F.sum("_floor").alias("_floors"), F.bround(exact, 0).cast("long").alias("_own"), F.count(F.lit(1)).alias("_rows"))
    wanted = sums.crossJoin(total) if total is not None else sums.withColumn("total", F.col("_own"))
    extra = F.col("total") - F.col("_floors")
    checked = F.when((extra < 0) | (extra > F.col("_rows")), F.raise_error(F.lit("No whole numbers near the values have the wanted sum")).cast("long")).otherwise(extra)
    ranked = only_row(enumerate_rows(rows, "_place", F.desc("_rest"), index), wanted.select(checked.alias("_extra")))
    return ranked.withColumn(out, F.col("_floor") + F.when(F.col("_place") < F.col("_extra"), 1).otherwise(0)).select(*df.columns, out)


def selected(df: DataFrame, value: str, weight: Column, wanted: Callable[[float], list[float]]) -> tuple[float, list]:
    """The total weight, and for each running weight in ``wanted(total)`` the least value at which it is reached.

    Nothing is sorted: each pass counts the weight in BUCKETS stretches of the range that still holds a wanted
    value, with map-side combining, and goes on in the stretch that reaches it, until that is a single value. Two
    or three passes are usual. Null and NaN take no part; without weight the values are null."""
    v = F.col(value)
    rows = df.select(v.alias("v"), weight.alias("w")).filter(v.isNotNull() & ~F.isnan(v.cast("double")))
    total, low, high = rows.agg(F.sum("w"), F.min("v"), F.max("v")).first()
    aims = wanted(total or 0)
    if not total:
        return 0, [None] * len(aims)
    ranges = [(low, high, 0)] * len(aims)  # least and greatest value, and the weight below them
    while open_ := sorted({r for r in ranges if r[0] != r[1]}):
        number, place = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (a, b, _) in enumerate(open_):
            within = (F.col("v") >= a) & (F.col("v") <= b)
            at = (F.col("v").cast("double") / 2 - float(a) / 2) / (float(b) / 2 - float(a) / 2) * BUCKETS
            number, place = F.when(within, i).otherwise(number), F.when(within, F.least(F.floor(at).cast("int"), F.lit(BUCKETS - 1))).otherwise(place)
        parts = rows.withColumn("range", number).filter("range IS NOT NULL").withColumn("place", place)
        parts = parts.groupBy("range", "place").agg(F.sum("w").alias("w"), F.min("v").alias("a"), F.max("v").alias("b"))
        order = Window.partitionBy("range").orderBy("place")  # at most BUCKETS rows of a range
        parts = parts.withColumn("upto", F.sum("w").over(order)).withColumn("before", F.lag("upto").over(order)).withColumn("last", F.lead("place").over(order).isNull())
        needs = {(open_.index(r), aim - r[2]) for aim, r in zip(aims, ranges, strict=True) if r in open_}
        reached = [(F.col("range") == i) & (F.col("upto") >= need) & (F.col("before").isNull() | (F.col("before") < need)) for i, need in needs]
        cut = parts.filter(reduce(Column.__or__, reached, F.col("last"))).orderBy("place").collect()  # two rows at most for each value that is wanted
        nearer = []
        for aim, r in zip(aims, ranges, strict=True):
            if r in open_:
                own = [x for x in cut if x["range"] == open_.index(r)]
                x = next((x for x in own if x.upto >= aim - r[2]), own[-1])  # the last one where sums of doubles fall short of the aim
                r = (x.a, x.b, r[2] + (x.before or 0))
            nearer.append(r)
        ranges = nearer
    return total, [r[0] for r in ranges]


def weighted_percentiles(df: DataFrame, value: str, weight: str, ps: dict[str, float]) -> DataFrame:
    """One row: by name the least value whose running weight reaches p of all weight; 0 without weight."""
    _, found = selected(df.filter(F.col(weight).isNotNull()), value, F.col(weight), lambda total: [total * p for p in ps.values()])
    return _one_row(df.sparkSession, {name: float(x or 0.0) for name, x in zip(ps, found, strict=True)})


def weighted_percentile(df: DataFrame, value: str, weight: str, p: float, out: str) -> DataFrame:
    return weighted_percentiles(df, value, weight, {out: p})


def _one_row(spark: SparkSession, row: dict[str, float]) -> DataFrame:
    return spark.range(1).select(*(F.lit(x).alias(name) for name, x in row.items()))


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with the same key, the one that came last."""
    values = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(*(F.max_by(c, order).alias(c) for c in values))


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    values = [c for c in df.columns if c not in (*keys, order)]
    return df.groupBy(*keys).agg(*(F.min_by(c, order).alias(c) for c in values))


def zero_filled(dimension: DataFrame, facts: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Sum of ``value`` for every key of the dimension, 0 where there are no facts."""
    sums = facts.groupBy(key).agg(F.sum(value).alias(out))
    return dimension.select(key).join(sums, key, "left").withColumn(out, F.coalesce(out, F.lit(0)))


def size_summary(df: DataFrame, value: str) -> DataFrame:
    """min, median, mean, p90, max of a column, percentiles interpolated between the two values around their
    place; zeros for an empty table."""
    stats = df.agg(F.count(value).alias("n"), F.min(value).alias("min"), F.avg(value).alias("mean"), F.max(value).alias("max")).first()
    shares = {"median": 0.5, "p90": 0.9}
    places = {name: p * max(stats.n - 1, 0) for name, p in shares.items()}
    _, found = selected(df, value, F.lit(1).cast("long"), lambda total: [x for at in places.values() for x in (math.floor(at) + 1, min(math.floor(at) + 2, total))])
    row = {"min": stats.min, "mean": stats.mean, "max": stats.max}
    for i, (name, at) in enumerate(places.items()):
        low, high = found[2 * i : 2 * i + 2]
        row[name] = None if low is None else float(low) + (float(high) - float(low)) * (at - math.floor(at))
    return _one_row(df.sparkSession, {name: float(row[name] or 0.0) for name in ("min", "median", "mean", "p90", "max")})
