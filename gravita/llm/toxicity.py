"""Toxic spans by a linear-chain conditional random field, and documents by its marginals.

Labels are given for documents. Tokens are labelled from them: in toxic documents of the sample, a word
with a form or beginning that is met almost only in toxic documents is toxic, all else is not. The field has two states and, for each token, features of its form, its beginnings, its end
and its two neighbours. Forward-backward marginals, run over whole texts, give each token's probability;
the largest one and the sum of those that matter give the document's score through a small logistic
regression, and runs of probable tokens give the offending offsets (in characters).

Defined results: null and empty texts have no tokens and the score of a text without evidence; whole texts
are learned from and scored, however long; without labelled rows of both kinds every score is 0. The sample
has at most ``sample`` documents of each label and is weighted back to the labels' shares in the table. Of
rows that share a doc_id the least text is learned, of its labels the larger; each such row is scored by its
own text. A null doc_id has no label and isn't learned. Ties need no rule. An empty table gives an empty
result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, bounded_sample, frugal, remainder, texts

SAMPLE = 1500
#: Weights kept: the largest, and none that are next to nothing.
WEIGHTS, LEAST_WEIGHT = 50_000, 0.02
THRESHOLD = 0.3
#: Words and bytes of text handled together, probability that matters in a sum.
REMEMBERED, BLOCK, MATTERS = 500_000, 16 << 20, 0.05
#: Log likelihood ratio from which a form is no accident.
SIGNIFICANT = 10.0
#: Word pairs by which copies among the sample are known.
SKETCH = 32
_WORD = re.compile(r"\S+")
_EDGES = ".,;:!?\"'()[]{}*%$&#|-_"


def bare(word: str) -> str:
    return word.lower().strip(_EDGES)


def forms(word: str) -> list[str]:
    """The word and what it begins and ends with."""
    w = bare(word)
    return [f"w{w}", *(f"b{w[:n]}" for n in (3, 4, 5, 6) if len(w) > n), f"e{w[-3:]}"]


def chains(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How to lay chains side by side: for tokens in order of place, then length, their index in the
    concatenated chains; and how many chains reach each place."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    reach = np.searchsorted(-lengths[order], -np.arange(1, longest + 1), side="right")
    start = (np.cumsum(lengths) - lengths)[order]
    where = np.concatenate([start[:n] + t for t, n in enumerate(reach)]) if longest else np.zeros(0, int)
    return where, reach


def marginals(score: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of state 1 of every token. Only odds of the states are passed along, so nothing
    under- or overflows; all chains of the block go side by side."""
    where, reach = chains(lengths)
    e = np.exp(np.clip(score[where], -30, 30))
    (a00, a01), (a10, a11) = np.exp(moves)
    cuts = np.concatenate([[0], np.cumsum(reach)])
    forward, back = np.empty_like(e), np.ones_like(e)
    before = None
    for t, n in enumerate(reach):
        here = slice(cuts[t], cuts[t + 1])
        forward[here] = e[here] if before is None else e[here] * (a01 + a11 * before[:n]) / (a00 + a10 * before[:n])
        before = np.clip(forward[here], 1e-30, 1e30)
    for t in range(len(reach) - 2, -1, -1):
        n = reach[t + 1]
        after = e[cuts[t + 1] : cuts[t + 2]] * back[cuts[t + 1] : cuts[t + 2]]
        back[cuts[t] : cuts[t] + n] = (a10 + a11 * after) / (a00 + a01 * after)
    odds = forward * back
    p = np.empty_like(e)
    p[where] = odds / (1 + odds)
    return p


class Field:
    """Weights, and the scores of the words met so far."""

    def __init__(self):
        self.own: dict[str, float] = {}
        self.before: dict[str, float] = {}
        self.after: dict[str, float] = {}
        self.moves = np.zeros((2, 2))
        self.document = np.zeros(3)
        self.learned = False
        self._at: dict[str, int] = {}
        self._rows: list[tuple[float, float, float]] = []

    def __getstate__(self):
        return self.__dict__ | {"_at": {}, "_rows": []}

    def _index(self, words: list[str]) -> np.ndarray:
        at = self._at
        try:
            return np.fromiter(map(at.__getitem__, words), np.int32, len(words))
        except KeyError:
            for w in words:
                if w not in at:
                    f = forms(w)
                    at[w] = len(self._rows)
                    self._rows.append((sum(self.own.get(x, 0.0) for x in f), self.before.get(f[0], 0.0), self.after.get(f[0], 0.0)))
            return np.fromiter(map(at.__getitem__, words), np.int32, len(words))

    def probabilities(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probability of every word of some texts, and the number of words of each."""
        if len(self._at) > REMEMBERED:
            self._at, self._rows = {}, []
        words = [self._index(t.split()) for t in found]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        own, before, after = np.array(self._rows or [(0.0, 0.0, 0.0)]).T
        w = np.concatenate(words) if words else np.zeros(0, np.int32)
        score = own[w]
        inner = np.ones(len(w), bool)
        inner[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
        i = np.flatnonzero(inner)
        score[i] += before[w[i - 1]]
        score[i - 1] += after[w[i]]
        return marginals(score, lengths, self.moves), lengths

    def evidence(self, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Columns 1, log odds of the largest probability, log of 1 + the sum of those that matter."""
        out = np.zeros((len(lengths), 3))
        out[:, 0], out[:, 1] = 1, -10
        some, start = lengths > 0, (np.cumsum(lengths) - lengths)
        if some.any():
            most = np.clip(np.maximum.reduceat(p, start[some]), 1e-6, 1 - 1e-6)
            out[some, 1] = np.clip(np.log(most / (1 - most)), -10, 10)
            out[some, 2] = np.log1p(np.add.reduceat(np.where(p > MATTERS, p, 0), start[some]))
        return out

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.document, -30, 30))) if self.learned else np.zeros(len(evidence))


def telling(seen: np.ndarray, toxic: int, clean: int, odds: float = 1.0) -> np.ndarray:
    """Which forms mark toxic documents: met almost only there (columns: toxic and other documents that
    have the form), and too often for chance by the log likelihood ratio against the base rate. ``odds``:
    how many times more documents of the table each other document stands for than each toxic one."""
    yes, n, base = seen[:, 0], seen.sum(1), toxic / (toxic + clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = yes * np.log(yes / n / base) + np.nan_to_num((n - yes) * np.log((n - yes) / n / (1 - base)))
    return (yes > 0.8 * (yes + odds * (n - yes))) & (yes > base * n) & (np.nan_to_num(ratio) > SIGNIFICANT)


def originals(tokens: list[np.ndarray]) -> np.ndarray:
    """Documents that share no more than half of their least word pairs with any one earlier original: of
    copies, whose words would count as often as they were copied, the first."""
    met: dict[int, list[int]] = {}
    out = np.zeros(len(tokens), bool)
    for i, t in enumerate(tokens):
        pairs = (t[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ t[1:].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        least = np.unique(pairs)[:SKETCH].tolist() or [-1 - int(t.sum())]
        shared = Counter(k for p in least for k in met.get(p, ()))
        out[i] = 2 * max(shared.values(), default=0) <= len(least)
        if out[i]:
            for p in least:
                met.setdefault(p, []).append(i)
    return out


def stands_for(toxic: np.ndarray, totals: tuple[int, int] | None) -> np.ndarray:
    """Weight of each document of a sample, 1 on average, that brings the labels back to their ``totals``
    (others, toxic) in the table."""
    if totals is None or not min(totals) or not toxic.any() or toxic.all():
        return np.ones(len(toxic))
    w = np.where(toxic, totals[1] / toxic.sum(), totals[0] / (~toxic).sum())
    return w / w.mean()


def train(found: list[str], toxic: np.ndarray, totals: tuple[int, int] | None = None) -> Field:
    """A field learned from all documents, weighted so that the labels have the shares of ``totals``. The documents' regression is learned from what fields of one
    half say of the other half, as a field knows its own words too well."""
    if not toxic.any() or toxic.all():
        return Field()
    weight = stands_for(toxic, totals)
    half = np.arange(len(found)) % 2 == 0
    x = np.zeros((len(found), 3))
    for own in (half, ~half):
        field = tagger([found[k] for k in np.flatnonzero(own)], toxic[own], weight[own])
        x[~own] = field.evidence(*field.probabilities([found[k] for k in np.flatnonzero(~own)]))
    field, w = tagger(found, toxic, weight), np.zeros(3)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * q * (1 - q))[:, None]).T @ x + np.eye(3) * 1e-1
        w -= np.linalg.solve(h, x.T @ (weight * (q - toxic)) + 1e-1 * w)
    field.document, field.learned = w, True
    return field


def tagger(found: list[str], toxic: np.ndarray, weight: np.ndarray, rounds: int = 25) -> Field:
    """Full-batch adaptive gradient on the weighted log likelihood of the token labels."""
    field = Field()
    odds = float(weight[~toxic].mean() / weight[toxic].mean()) if toxic.any() and not toxic.all() else 1.0
    known: dict[str, int] = {}
    tokens = [np.array([known.setdefault(w, len(known)) for w in t.split()], np.int64) for t in found]
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    form_at: dict[str, int] = {}
    own = [[form_at.setdefault(f, len(form_at)) for f in forms(w)] for w in known]
    word_of = np.repeat(np.arange(len(own)), list(map(len, own)))
    form_of = np.concatenate([np.array(x, np.int64) for x in own])
    seen = np.zeros((len(form_at), 2))
    first_of = originals(tokens)
    for t, y in zip((tokens[k] for k in np.flatnonzero(first_of)), toxic[first_of], strict=True):
        if len(t):
            seen[np.unique(np.concatenate([own[w] for w in np.unique(t)])), 0 if y else 1] += 1
    strong = telling(np.maximum(seen, 1e-9), int(toxic[first_of].sum()), int((~toxic[first_of]).sum()), odds)
    strong_word = np.bincount(word_of, strong[form_of], len(own)) > 0
    first = np.array([x[0] for x in own])
    weights = [np.zeros(len(form_at)) for _ in range(3)]
    token = np.concatenate(tokens)
    labels = (strong_word[token] & np.repeat(toxic, lengths)).astype(float)
    each = np.repeat(weight, lengths)
    inner = np.ones(len(token), bool)
    inner[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    i = np.flatnonzero(inner)
    pair = np.zeros((2, 2))
    np.add.at(pair, (labels[i - 1].astype(int), labels[i].astype(int)), each[i])
    field.moves = np.log((pair + 1) / (pair + 1).sum(1, keepdims=True))
    past = [np.full(len(form_at), 1e-6) for _ in range(3)]
    for _ in range(rounds):
        score = np.bincount(word_of, weights[0][form_of], len(own))[token]
        score[i] += weights[1][first][token[i - 1]]
        score[i - 1] += weights[2][first][token[i]]
        wrong = (marginals(score, lengths, field.moves) - labels) * each
        steps = (
            np.bincount(form_of, np.bincount(token, wrong, len(own))[word_of], len(form_at)),
            np.bincount(first, np.bincount(token[i - 1], wrong[i], len(own)), len(form_at)),
            np.bincount(first, np.bincount(token[i], wrong[i - 1], len(own)), len(form_at)),
        )
        for k, (weight, g) in enumerate(zip(weights, steps, strict=True)):
            g = g + 0.02 * weight
            past[k] += g * g
            weight -= (0.4 if k == 0 else 0.1) * g / np.sqrt(past[k])
    names = list(form_at)
    for held, w in zip((field.own, field.before, field.after), weights, strict=True):
        top = np.argsort(-np.abs(w), kind="stable")[:WEIGHTS]
        held.update((names[k], float(w[k])) for k in top if abs(w[k]) >= LEAST_WEIGHT)
    return field


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Learn from labelled rows whose crc32 remainder by 4 is not 2."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(remainder(F.col("doc_id"), 4) != 2)
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [bounded_sample(known.filter(F.col("toxic") == y), "doc_id", sample) for y in (0, 1)]
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")
    rows = sorted(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect(), key=lambda r: r.doc_id)
    return train([r.text for r in rows], np.array([r.toxic == 1 for r in rows], bool), (counts.get(0, 0), counts.get(1, 0)))


def offending(text: str, p: np.ndarray, least: float = 0.5) -> list[tuple[int, int]]:
    """Character offsets of runs of words with at least that probability."""
    out: list[tuple[int, int]] = []
    last = None
    for i, (m, q) in enumerate(zip(_WORD.finditer(text), p, strict=False)):
        if q >= least:
            if last == i - 1 and out:
                out[-1] = (out[-1][0], m.end())
            else:
                out.append(m.span())
            last = i
    return out


COLUMNS = "doc_id long, held_out boolean, score double, predicted int, spans array<struct<begin:int,end:int>>"


def _tag(field: Field):
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("spans", pa.list_(span))])

    @frugal
    def run(batches):
        for b in batches:
            found, at = texts(b.column("text")), 0
            while at < len(found):
                end, size = at, 0
                while end < len(found) and (end == at or size + len(found[end]) <= BLOCK):
                    size += len(found[end])
                    end += 1
                part = found[at:end]
                p, lengths = field.probabilities(part)
                score = field.scores(field.evidence(p, lengths))
                cuts = np.concatenate([[0], np.cumsum(lengths)])
                spans = [
                    [{"begin": x, "end": y} for x, y in offending(t, q)] if len(q) and q.max() >= 0.5 else []
                    for t, q in zip(part, (p[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)), strict=True)
                ]
                rows = b.slice(at, end - at)
                yield batch(schema, rows.column("doc_id"), rows.column("held_out"), score, (score >= THRESHOLD).astype(np.int32), spans)
                at = end

    return run


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, spans: one row for each row of ``docs``."""
    field = fit(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("long"), (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return rows.mapInArrow(_tag(field), COLUMNS)
