"""Quality by a factorisation machine.

Inputs are hashed words, statistics of a text's structure and the table's n_chars. The machine adds a
weight for each input and, for each pair of inputs, the product of their low-rank vectors; all pairs are
summed in time linear in the inputs by half of (sum squared minus sum of squares).

Defined results: null and empty texts have no words and zero statistics; whole texts are read, however long;
a null or missing n_chars counts as the text's length; without labelled rows of both kinds every score is 1.
The sample has at most ``sample`` documents of each label and is weighted back to the labels' shares in the
table. Of rows that share a doc_id the least text is learned, of its labels the smaller; each such row is
scored by its own text. A null doc_id has no label and isn't learned. Ties need no rule. An empty table
gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, bounded_sample, frugal, remainder, texts

SAMPLE = 1500
BUCKETS, RANK = 1 << 14, 6
THRESHOLD = 0.3
REMEMBERED = 500_000
_CLASSES = tuple(re.compile(p) for p in ("[A-Z]+", "[0-9]+", r"[.,;:]+", r"[!?]+", r"[|<>{}\[\]=/\\]+", r"[#$%&*+~^@_]+"))
STATISTICS = ("length", "claimed", "word_length", "distinct", "lines", "line_length", "repeated_lines", "capital", "digit", "stop", "exclaim", "markup", "symbol", "shouted", "repeated_pairs")


class Words(dict):
    """Bucket of each word met so far."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = out = crc32(word.lower().encode()) % BUCKETS
        return out


def statistics(text: str, claimed: int | None, ids: np.ndarray, words: list[str]) -> np.ndarray:
    n, lines = max(len(text), 1), text.split("\n")
    share = [sum(map(len, c.findall(text))) / n for c in _CLASSES]
    pairs = ids[1:] * np.int64(BUCKETS) + ids[:-1]
    return np.array([
        np.log1p(len(text)),
        np.log1p(max(claimed if claimed is not None else len(text), 0)),
        n / max(len(words), 1) if words else 0.0,
        len(np.unique(ids)) / max(len(ids), 1),
        np.log1p(len(lines)),
        np.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines),
        *share,
        sum(map(str.isupper, words)) / max(len(words), 1),
        1 - len(np.unique(pairs)) / max(len(pairs), 1),
    ])


def inputs(found: list[str], claimed: list, known: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse word inputs as (row, bucket, value) and the statistics of each text."""
    row, bucket, value, stats = [], [], [], []
    for i, (text, n) in enumerate(zip(found, claimed, strict=True)):
        words = text.split()
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        own, times = np.unique(ids, return_counts=True)
        x = np.sqrt(times)
        row.append(np.full(len(own), i))
        bucket.append(own)
        value.append(x / max(np.sqrt((x * x).sum()), 1e-9))
        stats.append(statistics(text, n, ids, words))
    return np.concatenate(row), np.concatenate(bucket), np.concatenate(value), np.array(stats)


class Machine:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        size = BUCKETS + len(STATISTICS)
        self.w0, self.w, self.v = 0.0, np.zeros(size), rng.normal(0, 0.01, (size, RANK))
        self.mean, self.scale = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))
        self.learned = False

    def joined(self, row, bucket, value, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word inputs and standardised statistics as one sparse table."""
        z = np.clip((stats - self.mean) / self.scale, -4, 4)
        k = len(STATISTICS)
        return (
            np.concatenate([row, np.repeat(np.arange(len(z)), k)]),
            np.concatenate([bucket, np.tile(BUCKETS + np.arange(k), len(z))]),
            np.concatenate([value, z.ravel() / np.sqrt(k)]),
        )

    def margin(self, row, col, x, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic curve, and each row's sums of vectors."""
        linear = np.bincount(row, self.w[col] * x, n)
        sums = np.stack([np.bincount(row, self.v[col, f] * x, n) for f in range(RANK)], 1)
        squares = np.bincount(row, (self.v[col] ** 2).sum(1) * x * x, n)
        return self.w0 + linear + ((sums**2).sum(1) - squares) / 2, sums

    def train(self, parts, y: np.ndarray, weight: np.ndarray | None = None, rounds: int = 150, rate: float = 0.1, decay: float = 2e-4) -> None:
        """``weight``: how much each document counts, 1 on average."""
        stats, weight = parts[3], np.ones(len(y)) if weight is None else weight
        self.mean = np.average(stats, 0, weight)
        self.scale = np.sqrt(np.average((stats - self.mean) ** 2, 0, weight)) + 1e-6
        row, col, x = self.joined(*parts)
        n, past_w, past_v, past_0 = len(y), np.full_like(self.w, 1e-8), np.full_like(self.v, 1e-8), 1e-8
        for _ in range(rounds):
            m, sums = self.margin(row, col, x, n)
            g = (1 / (1 + np.exp(-np.clip(m, -30, 30))) - y) * weight / n
            gw = np.bincount(col, g[row] * x, len(self.w)) + decay * self.w
            own = np.bincount(col, g[row] * x * x, len(self.w))
            gv = np.stack([np.bincount(col, g[row] * x * sums[row, f], len(self.w)) for f in range(RANK)], 1) - own[:, None] * self.v + decay * self.v
            past_w, past_v, past_0 = past_w + gw * gw, past_v + gv * gv, past_0 + g.sum() ** 2
            self.w -= rate * gw / np.sqrt(past_w)
            self.v -= rate * 0.2 * gv / np.sqrt(past_v)
            self.w0 -= rate * g.sum() / np.sqrt(past_0)
        self.learned = True

    def scores(self, parts, n: int) -> np.ndarray:
        if not self.learned:
            return np.ones(n)
        m, _ = self.margin(*self.joined(*parts), n)
        return 1 / (1 + np.exp(-np.clip(m, -30, 30)))


def stands_for(y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Weight of each document of a sample, 1 on average, that brings the labels back to their counts in the table."""
    w = np.select([y == k for k in counts], [n / max((y == k).sum(), 1) for k, n in counts.items()])
    return w / w.mean()


def claimed(docs: DataFrame) -> Column:
    """The table's n_chars, null where it has none."""
    return (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("long")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Learn from labelled rows whose crc32 remainder by 5 is not 0."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.filter(remainder(F.col("doc_id"), 5) != 0)
    counts = {r.quality: r.n for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [bounded_sample(known.filter(F.col("quality") == y), "doc_id", sample) for y in (0, 1)]
    found = docs.select("doc_id", F.struct(F.coalesce("text", F.lit("")).alias("text"), claimed(docs).alias("n_chars")).alias("row"))
    found = found.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")
    rows = sorted(found.groupBy("doc_id", "quality").agg(F.min("row").alias("row")).select("doc_id", "quality", "row.*").collect(), key=lambda r: r.doc_id)
    machine = Machine()
    y = np.array([float(r.quality) for r in rows])
    if len(counts) == 2:
        machine.train(inputs([r.text for r in rows], [r.n_chars for r in rows], Words()), y, stands_for(y, counts))
    return machine


def _score(machine: Machine):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    @frugal
    def run(batches):
        known = Words()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = texts(part.column("text"))
                score = machine.scores(inputs(found, part.column("n_chars").to_pylist(), known), len(found))
                yield batch(schema, part.column("doc_id"), part.column("held_out"), score, (score >= THRESHOLD).astype(np.int32))

    return run


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``."""
    machine = fit(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("long"), (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "text", claimed(docs).alias("n_chars"))
    return rows.mapInArrow(_score(machine), "doc_id long, held_out boolean, score double, predicted int")
