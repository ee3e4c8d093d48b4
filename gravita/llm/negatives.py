"""Hard negatives by a Voronoi-partitioned nearest-neighbour join.

Scores are integer inner products. One more component brings every row to the largest norm, after which a larger
inner product is a smaller Euclidean distance: d^2 = M^2 + |anchor|^2 - 2 score. Pivots, chosen from a bounded
sample, cut the space into Voronoi cells; every row goes to the cell of its nearest pivot. The anchors of a cell
are a group. A group first meets its own cell; what that finds bounds the distances at which a row can still
matter to any of its anchors. By the triangle inequality a row at distance d from the group's pivot is no nearer
to an anchor than d less the group's radius, and no further than d and that radius, and no nearer than the plane
between its pivot and the group's allows; so it is sent only to the groups whose bounds it meets. Rows sent to a
group are dealt to blocks, anchors to teams, and each pair of block and team is joined exactly.

That is done twice: for positives, the best rows of the anchor's label; and for negatives, the best rows of
other labels under a ceiling and over a floor that each positive's score sets.

Defined results: vectors that are null, hold null or non-finite components, or have another length than most
take no part, nor do rows with a null label or a null id, nor vectors so long (norm over 2^31 after scaling) that
a score wouldn't fit a long; the zero vector takes part. Rows alike in id, label and vector count once; an
anchor takes no row of its own id; of several anchors with one id each has its own positives and negatives, and
all are returned, equal rows once. Ties go to the smaller id, then to the smaller label. An anchor without
others of its label has no positives, a positive without rows in its range no negatives. An empty table gives an
empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, batch, bounded_sample, frugal

EVERY, SCALE, POSITIVES, NEGATIVES = 50, 256, 5, 3
#: Rows (of 64 components; fewer of longer ones) the pivots are chosen from, rows for each pivot, most pivots;
#: rows of a block and anchors of a team; scores that a task holds at once.
SAMPLE, CELL, PIVOTS, BLOCK, TEAM = 8192, 4096, 1024, 8192, 1024
HELD = 1 << 22
#: Share of the largest norm by which distances may be off in double precision.
SLACK = 1e-6
ROWS = "vec_id long, label long, v binary"


def scaled_rows(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v (floor of each scaled component, as doubles), norm2 of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    # a double that is an integer already: floor() of a column would cut it to a long; -0.0 and 0.0 are made one
    whole = lambda c: F.when(F.abs(c) < 2.0**62, F.floor(c).cast("double")).otherwise(c) + F.lit(0.0)
    rows = rows.select("vec_id", "label", F.transform("v", lambda c: whole(c * F.lit(float(scale)))).alias("v"))
    return rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).filter(F.col("norm2") < 2.0**62).distinct()


def matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), "<f8").reshape(-1, dim)


def scores(q: np.ndarray, x: np.ndarray, exact_doubles: bool) -> np.ndarray:
    """Integer inner products; where doubles can't hold them all, in 64-bit integers."""
    return (q @ x.T).astype(np.int64) if exact_doubles else q.astype(np.int64) @ x.astype(np.int64).T


def ceiling(score: np.ndarray) -> np.ndarray:
    """Largest s with 100 s <= 95 score."""
    return score // 20 * 19 + score % 20 * 19 // 20


def floor_(score: np.ndarray) -> np.ndarray:
    """Least s with 100 s >= 50 score."""
    return -(-score // 2)


@dataclass(frozen=True)
class Cells:
    """Pivots and what is asked of rows brought to the largest norm."""

    pivots: np.ndarray
    norm2: float

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(self.norm2 - (x * x).sum(1), 0))[:, None]])

    def distances(self, y: np.ndarray) -> np.ndarray:
        """Of points with the extra component to each pivot."""
        square = (y * y).sum(1)[:, None] + (self.pivots * self.pivots).sum(1) - 2 * y @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    def anchors(self, q: np.ndarray) -> np.ndarray:
        return np.hstack([q, np.zeros((len(q), 1))])

    def reach(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance of an anchor to a row with that score."""
        return np.sqrt(np.maximum(self.norm2 + (q * q).sum(1) - 2 * score, 0))


def best_positives(asked: pd.DataFrame, held: pd.DataFrame, dim: int, k: int, doubles: bool):
    """(anchor, vec_id, label, score) of the k best rows of each anchor's label in a block."""
    q, x = matrix(asked.v, dim), matrix(held.v, dim)
    ids, labels = held.vec_id.to_numpy(), held.label.to_numpy()
    out = []
    for label, who in asked.groupby("label", sort=False).indices.items():
        rows = np.flatnonzero(labels == label)
        if not len(rows):
            continue
        step = max(1, HELD // len(rows))
        for begin in range(0, len(who), step):
            some = who[begin : begin + step]
            for i, s in zip(some, scores(q[some], x[rows], doubles), strict=True):
                at = np.flatnonzero((ids[rows] != asked.vec_id.iat[i]) & (s >= asked.least.iat[i]))
                if len(at) > 4 * k:
                    at = at[s[at] >= np.partition(s[at], len(at) - k)[len(at) - k]]
                top = at[np.lexsort((ids[rows[at]], -s[at]))][:k]
                out += [(asked.anchor.iat[i], ids[rows[t]], label, s[t]) for t in top]
    return out


def best_negatives(asked: pd.DataFrame, held: pd.DataFrame, dim: int, k: int, doubles: bool):
    """(anchor, place, vec_id, label, score): in a block the k best rows of other labels in each positive's range."""
    q, x = matrix(asked.v, dim), matrix(held.v, dim)
    ids, labels = held.vec_id.to_numpy(), held.label.to_numpy()
    order = np.lexsort((labels, ids))  # stable sorting by score keeps ties in this order
    ids, labels, x = ids[order], labels[order], x[order]
    out, step = [], max(1, HELD // len(held))
    for begin in range(0, len(q), step):
        found = scores(q[begin : begin + step], x, doubles)
        for i, s in enumerate(found, begin):
            wins, least = np.asarray(asked.wins.iat[i], np.int64), np.asarray(asked.leasts.iat[i], np.int64)
            top = ceiling(wins)
            at = np.flatnonzero((s <= top.max()) & (s >= least.min()) & (labels != asked.label.iat[i]) & (ids != asked.vec_id.iat[i]))
            at = at[np.argsort(-s[at], kind="stable")]
            falling = -s[at]
            for place, (high, low) in enumerate(zip(top, least, strict=True)):
                first = np.searchsorted(falling, -high, "left")
                for t in at[first : first + k]:
                    if s[t] < low:
                        break
                    out.append((asked.anchor.iat[i], place, ids[t], labels[t], s[t]))
    return out


class Join:
    """One Voronoi join: ``rows`` (vec_id, label, v, cell, far) meet groups of anchors."""

    def __init__(self, scratch: Scratch, cells: Cells, rows: DataFrame, dim: int, block: int, team: int):
        self.scratch, self.cells, self.rows, self.dim, self.block, self.team = scratch, cells, rows, dim, block, team

    def met(self, asked: DataFrame, sent: DataFrame, kernel, result: str) -> DataFrame:
        """Anchors (with their cell as group) beside the rows sent to it, block by block and team by team."""
        count = lambda df, size, name: df.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias(name))
        sizes = count(asked, self.team, "teams").join(count(sent, self.block, "blocks"), "group")  # at most a row for each pivot
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        dealt = lambda c, n: F.pmod(F.xxhash64(c), n)
        on = ["group", "team", "block"]
        left = asked.join(F.broadcast(sizes), "group").withColumn("team", dealt("anchor", "teams")).withColumn("block", every("blocks"))
        right = sent.join(F.broadcast(sizes), "group").withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "v"), "blocks")).withColumn("team", every("teams"))
        names = [f.split()[0] for f in result.split(", ")]

        def match(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(kernel(a, b) if len(a) and len(b) else [], columns=names)

        return self.scratch.write(left.drop("teams", "blocks").groupBy(*on).cogroup(right.drop("teams", "blocks").groupBy(*on)).applyInPandas(match, result))

    def home(self) -> DataFrame:
        return self.rows.select("vec_id", "label", "v", F.col("cell").alias("group"))

    def away(self, bounds: dict[int, tuple[float, float, float]]) -> DataFrame:
        """Rows sent to the groups, other than their own cell's, that they might serve.

        bounds: for each group its radius, and the least and largest distance at which it still wants rows."""
        cells, dim, off = self.cells, self.dim, SLACK * float(np.sqrt(self.cells.norm2)) + 1e-9
        groups = np.array(sorted(bounds), np.int64)
        radius, near, far = (np.array([bounds[int(g)][i] for g in groups]) for i in range(3))
        between = cells.distances(cells.pivots)  # of pivots, for the planes between them
        schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.binary()), ("group", pa.int64())])

        @frugal
        def run(batches):
            for b in batches:
                for at in range(0, b.num_rows, 2048):
                    part = b.slice(at, 2048)
                    d = cells.distances(cells.lifted(matrix(part.column("v").to_pylist(), dim)))
                    own = part.column("cell").to_numpy()
                    to = d[:, groups]
                    wanted = (to - radius <= far + off) & (to + radius >= near - off) & (own[:, None] != groups)
                    # a row is on its own pivot's side of the plane to the group's pivot, an anchor on the other
                    gap = np.maximum(between[own][:, groups], 1e-300)
                    plane = (to * to - d[np.arange(len(d)), own][:, None] ** 2) / (2 * gap)
                    wanted &= plane <= far + off
                    row, group = np.nonzero(wanted)
                    yield batch(schema, *(part.column(c).take(pa.array(row)) for c in ("vec_id", "label", "v")), groups[group])

        return self.rows.select("vec_id", "label", "v", "cell").mapInArrow(run, f"{ROWS}, group long")


def _bounds(anchors: DataFrame) -> dict[int, tuple[float, float, float]]:
    """By group, at most one for each pivot: radius, nearest and furthest distance wanted."""
    found = anchors.groupBy("group").agg(F.max("far"), F.min("near"), F.max("furthest")).collect()
    return {r[0]: (r[1], r[2], r[3]) for r in found}


def hard_negatives(
    spark: SparkSession,
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    scale: int = SCALE,
    cell: int = CELL,
    block: int = BLOCK,
    team: int = TEAM,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for each row whose id is divisible by ``every``."""
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    scratch = Scratch(spark, "negatives")
    usable = scratch.write(scaled_rows(vectors, id_col, vec_col, label_col, scale))
    common = usable.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("norm2")).orderBy(F.desc("n"), "dim").first()
    if common is None or not common.dim:
        return spark.createDataFrame([], empty)
    dim, doubles = common.dim, bool(common.norm2 < 2.0**52)
    usable = usable.filter(F.size("v") == dim)
    lift = Cells(np.zeros((0, dim + 1)), float(common.norm2))
    sample = np.array([r.v for r in bounded_sample(usable, "vec_id", max(64, min(SAMPLE, 64 * SAMPLE // dim))).select("v").collect()], float).reshape(-1, dim)
    count = int(min(PIVOTS, max(1, common.n // cell)))
    pivots = np.unique(lift.lifted(sample), axis=0)
    cells = Cells(pivots[np.random.default_rng(7).permutation(len(pivots))[:count]], lift.norm2)

    def placed(batches):
        for b in batches:
            x = b.column("v").flatten().to_numpy().reshape(-1, dim)
            d = cells.distances(cells.lifted(x))
            packed = pa.array([r.tobytes() for r in x.astype("<f8")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), packed, pa.array(d.argmin(1).astype(np.int64))], names=["vec_id", "label", "v", "cell"])

    rows = scratch.write(usable.mapInArrow(placed, f"{ROWS}, cell long"))
    join = Join(scratch, cells, rows, dim, block, team)

    def grouped(batches):
        """Anchors go to the group of their own nearest pivot; they lie in the plane without the extra component."""
        for b in batches:
            d = cells.distances(cells.anchors(matrix(b.column("v").to_pylist(), dim)))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("anchor", "vec_id", "label", "v")), pa.array(d.argmin(1).astype(np.int64)), pa.array(d.min(1))], names=["anchor", "vec_id", "label", "v", "group", "far"]
            )

    asked = rows.filter(F.col("vec_id") % every == 0).select(F.monotonically_increasing_id().alias("anchor"), "vec_id", "label", "v")
    anchors = scratch.write(asked.mapInArrow(grouped, f"anchor long, {ROWS}, group long, far double"))

    # Positives
    result = "anchor long, vec_id long, label long, score long"
    kernel = lambda a, b: best_positives(a, b, dim, positives, doubles)
    none = -(2**63)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives)
    first = join.met(anchors.withColumn("least", F.lit(none)), join.home(), kernel, result)
    found = ranked(first).filter(F.col("rank") == positives).select("anchor", F.col("score").alias("least"))
    bounded = anchors.join(found, "anchor", "left").withColumn("least", F.coalesce("least", F.lit(none)))

    def reaching(batches):
        """The distance beyond which no row can be among the best."""
        for b in batches:
            q, least = matrix(b.column("v").to_pylist(), dim), b.column("least").to_numpy().astype(float)
            reach = np.where(least > none, cells.reach(q, least), np.inf)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.zeros(len(q))), pa.array(reach)], names=[*b.schema.names, "near", "furthest"])

    more = f"anchor long, {ROWS}, group long, far double"
    wanting = scratch.write(bounded.select("anchor", "vec_id", "label", "v", "group", "far", "least").mapInArrow(reaching, f"{more}, least long, near double, furthest double"))
    rest = join.met(wanting.drop("near", "furthest"), join.away(_bounds(wanting)), kernel, result)
    best = scratch.write(ranked(first.unionByName(rest)).select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "rank"))

    # Negatives, of all positives whose range isn't empty
    wins = best.filter("positive_score >= 0").groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("own"))
    wins = anchors.join(wins, "anchor").withColumn("wins", F.col("own.positive_score"))
    wins = scratch.write(wins.withColumn("leasts", F.transform("wins", lambda s: F.shiftright(s + 1, 1))))
    result = "anchor long, place int, vec_id long, label long, score long"
    kernel = lambda a, b: best_negatives(a, b, dim, negatives, doubles)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "label")
    chosen = lambda df: df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    asked = wins.drop("own")
    first = join.met(asked, join.home(), kernel, result)
    full = chosen(first).filter(F.col("rank") == negatives).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("least_at"))
    tighter = F.transform("leasts", lambda s, i: F.coalesce(F.try_element_at("least_at", i.cast("int")), s))
    bounded = asked.join(full, "anchor", "left").withColumn("leasts", tighter)

    def ringed(batches):
        """Between the ceiling of the best positive and the lowest score that any range still lacks."""
        for b in batches:
            q = matrix(b.column("v").to_pylist(), dim)
            top = np.array([ceiling(max(w)) for w in b.column("wins").to_pylist()], float)
            low = np.array([min(w) for w in b.column("leasts").to_pylist()], float)
            near, far = cells.reach(q, top), cells.reach(q, low)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near), pa.array(far)], names=[*b.schema.names, "near", "furthest"])

    ask = f"{more}, wins array<long>, leasts array<long>"
    wanting = scratch.write(bounded.select("anchor", "vec_id", "label", "v", "group", "far", "wins", "leasts").mapInArrow(ringed, f"{ask}, near double, furthest double"))
    rest = join.met(wanting.drop("near", "furthest"), join.away(_bounds(wanting)), kernel, result)
    rows = chosen(first.unionByName(rest)).join(wins.select("anchor", F.col("vec_id").alias("anchor_id"), "own"), "anchor")
    own = F.col("own")[F.col("place")]
    return rows.select(
        "anchor_id", own["positive_id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        own["positive_score"].alias("positive_score"), F.col("score").alias("negative_score"),
    ).distinct()
