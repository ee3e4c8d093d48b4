"""Approximate nearest neighbours by few stable projections and a kd-tree over them.

Largest inner product becomes least Euclidean distance by one more component, which brings all rows to
the largest norm. Gaussian projections to ``DIMS`` numbers keep distances: projected over true squared
distance has a chi-square distribution with ``DIMS`` degrees of freedom. A kd-tree splits the projected
space, its upper levels fitted on a bounded sample and used by every row, its lower levels built in each
block. A query takes the leaves in order of projected distance, verifies their rows on the original
vectors, and stops when a row still unseen would be nearer than the k-th best only with probability
under 1 - ``SURE``. That test also decides which cells a query enters after its home cells.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part; rows that repeat a vec_id with the same vector count once; ties go to the
smaller vec_id; of rows that repeat a vec_id with other vectors each is a candidate, and the vec_id's best
score counts; rows without a vec_id take no part; an empty table gives an empty result; other columns,
whatever their names, are not read. Of identical vectors only the k + 1 smallest ids
are indexed, as no query can be nearer to any other.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, batch, bounded_sample

K, EVERY = 20, 20
DIMS, SURE, SEED = 8, 0.97, 17
#: Rows the tree is fitted on, most cells, rows in a block and in a leaf, queries that meet a block at once.
SAMPLE, CELLS, BLOCK, LEAF, QUERIES = 16384, 4096, 4096, 64, 32768
HOMES = 2


def chi_square(x: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    h = np.minimum(np.asarray(x, float) / 2, 700)
    return 1 - np.exp(-h) * sum(h**i / math.factorial(i) for i in range(dims // 2))


class Projection:
    """Projections of rows and queries, after the rows' norms were brought to the largest."""

    def __init__(self, dim: int, norm2: float):
        self.norm2 = norm2
        self.matrix = np.random.default_rng(SEED).normal(size=(dim + 1, DIMS))

    def rows(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm2 - (x * x).sum(1), 0))
        return x @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.matrix[:-1]

    def distance2(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        return np.maximum((q * q).sum(1) + self.norm2 - 2 * score, 1e-12)


def halves(p: np.ndarray, least: int) -> list[np.ndarray]:
    """Leaves of a kd-tree: rows cut at the median of the widest side until ``least`` are left."""
    todo, out = [np.arange(len(p))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= least:
            out.append(rows)
            continue
        part = p[rows]
        order = np.argsort(part[:, np.ptp(part, axis=0).argmax()], kind="stable")
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


class Tree:
    """Upper levels: splits as (side, cut, left, right); a negative child is cell -1 - child."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.nodes: list[tuple] = []
        self.cells = 0
        self.root = self._grow(sample, cells)

    def _grow(self, p: np.ndarray, cells: int) -> int:
        side = int(np.ptp(p, axis=0).argmax()) if len(p) else 0
        if cells <= 1 or len(p) < 2 or np.ptp(p[:, side]) == 0:
            self.cells += 1
            return -self.cells
        cut = float(np.median(p[:, side]))
        left = p[:, side] < cut
        if not left.any():
            cut = float(p[p[:, side] > cut, side].min()) if (p[:, side] > cut).any() else cut
            left = p[:, side] < cut
        at = len(self.nodes)
        self.nodes.append(())
        self.nodes[at] = (side, cut, self._grow(p[left], cells // 2), self._grow(p[~left], cells - cells // 2))
        return at

    def cell(self, p: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(p), np.int64), [(self.root, np.arange(len(p)))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                out[rows] = -1 - at
            elif len(rows):
                side, cut, left, right = self.nodes[at]
                low = p[rows, side] < cut
                todo += [(left, rows[low]), (right, rows[~low])]
        return out


def box_distance2(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least squared distance of each query to each box."""
    return np.stack([(np.maximum(np.maximum(a - q, q - b), 0) ** 2).sum(1) for a, b in zip(low, high, strict=True)], 1)


def search(proj: Projection, ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int, sure: float) -> tuple:
    """The k best rows of a block for each query that reach the bound: (query, row, score)."""
    p, qp = proj.rows(x), proj.queries(q)
    leaves = halves(p, LEAF)
    reach2 = box_distance2(qp, np.array([p[i].min(0) for i in leaves]), np.array([p[i].max(0) for i in leaves]))
    order = np.argsort(reach2, 1, kind="stable")
    slack = 1e-9 * np.sqrt((q * q).sum(1) * proj.norm2)
    best = [(np.zeros(0), np.zeros(0, np.int64))] * len(q)
    kth = bound.copy()
    active = np.arange(len(q))
    for t in range(len(leaves)):
        leaf = order[active, t]
        open_ = chi_square(reach2[active, leaf] / proj.distance2(q[active], kth[active])) < sure
        active, leaf = active[open_], leaf[open_]
        if not len(active):
            break
        for m in np.unique(leaf):
            who, rows = active[leaf == m], leaves[m]
            near = q[who] @ x[rows].T >= (kth[who] - slack[who])[:, None]
            for i, hits in zip(who, near, strict=True):
                found = rows[hits]
                found = found[ids[found] != q_ids[i]]
                if not len(found):
                    continue
                score = (x[found] * q[i]).sum(1)
                score, found = np.concatenate([best[i][0], score]), np.concatenate([best[i][1], found])
                top = np.lexsort((ids[found], -score))[:k]
                best[i] = score[top], found[top]
                if len(top) == k:
                    kth[i] = max(kth[i], best[i][0][-1])
    n = [len(s) for s, _ in best]
    found = np.concatenate([r for _, r in best]) if best else np.zeros(0, np.int64)
    score = np.concatenate([s for s, _ in best]) if best else np.zeros(0)
    keep = score >= np.repeat(bound, n)
    return np.repeat(q_ids, n)[keep], ids[found][keep], score[keep]


def _matrix(column, dim: int) -> np.ndarray:
    return np.concatenate([np.asarray(v, float) for v in column]).reshape(-1, dim) if len(column) else np.zeros((0, dim))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, v (doubles), of rows that take part, whatever their length."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(finite & F.exists("v", lambda c: c != 0)).distinct()


def nearest(
    spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = EVERY, sure: float = SURE, block: int = BLOCK
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every``, its k nearest others."""
    scratch = Scratch(spark, "nearest")
    rows = scratch.write(usable(vectors, id_col, vec_col))
    common = rows.groupBy(F.size("v").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).alias("norm2")
    ).orderBy(F.desc("n"), "dim").first()
    result = "query_id long, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, proj = common.dim, Projection(common.dim, float(common.norm2))
    rows = rows.filter(F.size("v") == dim)
    queries = rows.filter(F.col("vec_id") % every == 0)
    copies = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    indexed = rows.withColumn("copy", copies).filter(F.col("copy") <= k + 1).drop("copy")
    sample = _matrix([r.v for r in bounded_sample(rows, "vec_id", SAMPLE).select("v").collect()], dim)
    tree = Tree(proj.rows(sample), int(min(CELLS, max(1, common.n // block))))

    def placed(batches):
        for b in batches:
            x = b.column("v").flatten().to_numpy().reshape(-1, dim)
            p = proj.rows(x)
            low = pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), DIMS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), low, pa.array(tree.cell(p))], names=["vec_id", "v", "p", "cell"])

    cells = scratch.write(indexed.mapInArrow(placed, "vec_id long, v array<double>, p array<double>, cell long"))
    sides = [f(F.col("p")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(DIMS)]
    boxes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *sides).orderBy("cell").collect()  # at most CELLS rows
    cell_ids = np.array([r.cell for r in boxes])
    size = np.array([r.n for r in boxes])
    low, high = (np.array([[r[f"{n}{i}"] for i in range(DIMS)] for r in boxes]) for n in ("low", "high"))
    parts = -(-size // block)
    queried = not queries.isEmpty()

    def homes(batches):
        """Blocks of the nearest cells that are large enough to give a bound."""
        schema = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.float64())), ("bound", pa.float64()), ("cell", pa.int64()), ("part", pa.int64())])
        large = np.flatnonzero(size > k) if (size > k).any() else np.arange(len(size))
        for b in batches:
            q = b.column("v").flatten().to_numpy().reshape(-1, dim)
            near = np.argsort(box_distance2(proj.queries(q), low[large], high[large]), 1, kind="stable")[:, :HOMES]
            at = np.repeat(np.arange(len(q)), near.shape[1])
            yield batch(
                schema, b.column("vec_id").take(pa.array(at)), b.column("v").take(pa.array(at)), np.full(len(at), -np.inf),
                cell_ids[large][near.ravel()], np.zeros(len(at), np.int64),
            )

    def entered(batches):
        """All other blocks that the test doesn't exclude."""
        schema = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.float64())), ("bound", pa.float64()), ("cell", pa.int64()), ("part", pa.int64())])
        large = np.flatnonzero(size > k) if (size > k).any() else np.arange(len(size))
        for b in batches:
            q = b.column("v").flatten().to_numpy().reshape(-1, dim)
            bound = b.column("bound").to_numpy(zero_copy_only=False)
            bound = np.where(np.isnan(bound), -np.inf, bound)
            reach2 = box_distance2(proj.queries(q), low, high)
            home = large[np.argsort(reach2[:, large], 1, kind="stable")[:, :HOMES]]
            go = chi_square(reach2 / proj.distance2(q, bound)[:, None]) < sure
            at, cell, part = [], [], []
            for i in range(len(q)):
                for c in np.flatnonzero(go[i] | np.isin(np.arange(len(size)), home[i])):
                    first = 1 if c in home[i] else 0
                    if go[i, c] or not first:
                        part += range(first, parts[c])
                        at += [i] * (parts[c] - first)
                        cell += [cell_ids[c]] * (parts[c] - first)
            take = pa.array(np.array(at, np.int64))
            yield batch(schema, b.column("vec_id").take(take), b.column("v").take(take), bound[np.array(at, np.int64)], cell, part)

    blocks = spark.createDataFrame([(int(c), int(n)) for c, n in zip(cell_ids, parts, strict=True)], "cell long, parts long")  # at most CELLS rows
    data = cells.join(F.broadcast(blocks), "cell").select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), "parts").alias("part"))

    def match(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        a, b, c = search(
            proj, held.vec_id.to_numpy(), _matrix(held.v, dim), asked.query_id.to_numpy(), _matrix(asked.q, dim), asked.bound.to_numpy(), k, sure
        )
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})

    def met(asked: DataFrame) -> DataFrame:
        """Queries beside the blocks that they enter. A block goes out once for every QUERIES of them, and
        not at all where none enters."""
        asked = scratch.write(asked)
        groups = asked.groupBy("cell", "part").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("long").alias("groups"))
        keyed = asked.join(groups, ["cell", "part"]).withColumn("group", F.pmod(F.xxhash64("query_id"), "groups")).drop("groups")
        held = data.join(groups, ["cell", "part"]).withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).drop("groups")
        on = ["cell", "part", "group"]
        return keyed.groupBy(*on).cogroup(held.groupBy(*on)).applyInPandas(match, result)

    asked = "query_id long, q array<double>, bound double, cell long, part long"
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    if not queried:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    first = scratch.write(met(queries.mapInArrow(homes, asked)).distinct())
    ranked = first.withColumn("rank", F.row_number().over(order))
    bounds = ranked.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    again = queries.join(bounds, "vec_id", "left").mapInArrow(entered, asked)
    every_hit = first.unionByName(met(again)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    out = every_hit.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
