"""Language identification by error-correcting output codes.

Each language has a codeword; one binary classifier on hashed byte n-grams predicts each bit. Decoding
sums a logistic loss a bit, weighted by how well that bit was learned, and takes the codeword with the
least loss. Two codewords almost equally near flag the document as ambiguous.

Defined results: a text that is null or has no letter gives ``und`` with score 0; the score is the
softmax of the negative losses at the chosen language; with one learned language that one is returned
with score 1, with none every text gives ``und``; ties between codewords go to the smaller language name.
Whole texts are read, however long; only the training rows are a sample, of at most ``sample`` documents,
chosen by a hash of the doc_id. Rows that share a doc_id or have none are predicted one by one. An empty
table gives an empty result; other columns, whatever their names, are not read (``keep_identified`` keeps
them).
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, bounded_sample, frugal, remainder, texts

SAMPLE = 2000
DIMENSIONS = 4096
AMBIGUOUS = 0.02
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def features(text: str, dims: int = DIMENSIONS) -> np.ndarray:
    """Unit vector of the hashed 1-, 2- and 3-grams of the lower-cased UTF-8 bytes."""
    a = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    shift = np.uint32(32 - dims.bit_length() + 1)
    grams = [a * _MIX[0]]
    for n in (1, 2):
        if a.size > n:
            grams.append((grams[-1][:-1] ^ (a[n:] + np.uint32(n))) * _MIX[n])
    counts = np.bincount(np.concatenate(grams) >> shift, minlength=dims).astype(np.float32)
    return counts / max(np.sqrt(np.dot(counts, counts)), 1e-9)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k rows of -1 and 1. Up to 6 classes: every split of the classes is a column, so that any two
    rows differ in over half of the columns. Beyond: the most spread of 64 random codes."""
    if k < 2:
        return np.ones((k, 0), np.float32)
    if k <= 6:
        splits = [(1, *s) for s in itertools.product((1, -1), repeat=k - 1) if -1 in s]
        return np.array(splits, np.float32).T
    rng, length = np.random.default_rng(seed), max(15, 8 * int(np.ceil(np.log2(k))))
    best, spread = None, -1
    for _ in range(64):
        code = rng.choice(np.float32([-1, 1]), (k, length))
        code = code[:, np.abs(code.sum(0)) < k]
        apart = ((code.shape[1] - code @ code.T) / 2 + np.eye(k) * length).min()
        if apart > spread:
            best, spread = code, apart
    return best


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 80, rate: float = 4.0, decay: float = 1e-4) -> tuple:
    """Full-batch logistic regressions, one a column of y (-1 or 1), by momentum descent."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):
        g = -y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30))) / len(x)
        vw, vb = 0.9 * vw - rate * (x.T @ g + decay * w), 0.9 * vb - rate * 0.1 * g.sum(0)
        w, b = w + vw, b + vb
    return w, b


class Coder:
    """Learned bits, their weights and the languages' codewords."""

    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages))
        if len(languages) < 2:
            return
        bits = self.code[y]
        self.w, self.b = logistic(x, bits)
        self.weight = np.maximum(((x @ self.w + self.b) * bits > 0).mean(0) - 0.5, 0.01)
        self.weight /= self.weight.sum()

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its score, and whether another is almost as near."""
        if len(self.languages) < 2:
            return np.zeros(len(x), int), np.ones(len(x)), np.zeros(len(x), bool)
        margin = x @ self.w + self.b
        loss = np.stack([np.logaddexp(0, -margin * row) @ self.weight for row in self.code], 1)
        best = loss.argmin(1)
        p = np.exp(-len(self.weight) * (loss - loss.min(1, keepdims=True)))
        p /= p.sum(1, keepdims=True)
        near = np.sort(loss, 1)
        return best, p[np.arange(len(x)), best], near[:, 1] - near[:, 0] < AMBIGUOUS


def fit(docs: DataFrame, sample: int = SAMPLE) -> Coder:
    """Learn from rows whose crc32 remainder by 4 is not 2 and that have a language and a text."""
    rows = docs.select("doc_id", "text", "lang").filter(
        (remainder(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    known = [(r.text, r.lang) for r in bounded_sample(rows, "doc_id", sample).collect()]
    languages = sorted({lang for _, lang in known})
    at = {lang: i for i, lang in enumerate(languages)}
    x = np.stack([features(t) for t, _ in known]) if known else np.zeros((0, DIMENSIONS), np.float32)
    return Coder(languages, x, np.array([at[lang] for _, lang in known], int))


def _predict(coder: Coder):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    @frugal
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                found = texts(part.column("text"))
                known = [i for i, t in enumerate(found) if coder.languages and any(map(str.isalpha, t))]
                name, score, unsure = ["und"] * len(found), [0.0] * len(found), [True] * len(found)
                if known:
                    for i, k, s, u in zip(known, *coder.decode(np.stack([features(found[i]) for i in known])), strict=True):
                        name[i], score[i], unsure[i] = coder.languages[k], min(1.0, float(s)), bool(u)
                yield batch(schema, part.column("doc_id"), part.column("held_out"), name, score, unsure)

    return run


def identify(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous: one row for each row of ``docs``."""
    coder = fit(docs, sample)
    rows = docs.select(F.col("doc_id").cast("long"), (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return rows.mapInArrow(_predict(coder), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def keep_identified(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose language is known: texts without a letter, and ambiguous texts with a
    score under ``least``, go. Rows pass through one function with their columns, whatever their names, so no
    text is shuffled."""
    coder = fit(docs, sample)
    decide, at = _predict(coder), docs.columns.index("text")

    @frugal
    def run(batches):
        for b in batches:
            ids = pa.nulls(b.num_rows, pa.int64())
            text = b.column("row").flatten()[at]
            view = pa.RecordBatch.from_arrays([ids, pa.nulls(b.num_rows, pa.bool_()), text], names=["doc_id", "held_out", "text"])
            keep = [
                name != "und" and not (unsure and score < least)
                for part in decide([view])
                for name, score, unsure in zip(*(part.column(i).to_pylist() for i in (2, 3, 4)), strict=True)
            ]
            yield b.filter(pa.array(keep, pa.bool_()))

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return rows.mapInArrow(run, rows.schema).select("row.*")
