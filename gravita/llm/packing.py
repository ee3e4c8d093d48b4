"""Packing by lexical retrieval.

Documents become token ids once, in a table in the shared folder. Document frequencies and the mean
length are counted over all documents. BM25 weights of a document's ids, projected to a few numbers, place
it on a shelf of a kd-tree that is fitted on a bounded sample; rows are dealt to tasks by shelf, so that
related documents meet whatever files they came from. A task works along its shelves in shards of bounded
size: it builds a BM25 inverted index over a shard, a seed document is followed by its best unused
neighbours there until the window is full, and the document that is cut at the window's end seeds the next
with what is left of it. A shelf that holds more than a task's share (copies of one text, say) is dealt to
several tasks by row.

Every id is placed exactly once. The last window of a task is cut into sequences whose lengths are powers
of two, so no sequence needs padding. Work and memory follow the rows: shards have a fixed size, and a
seed asks the shard on its own shelf only.

Defined results: null text is empty and has the end id alone; rows that repeat a doc_id or whose doc_id is
null are packed one by one; very long texts are cut over as many windows as they need, and one beyond a
shard's size is a shard by itself; ties between neighbours go to the earlier row; an empty table gives an
empty result; other columns, whatever their names, are not read. A sequence's id holds its task and its
number there.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, frugal, numbered
from .tokens import library_encoder

WINDOW, END = 2048, 1
#: Documents and ids in a shard at most (a longer document is a shard by itself); BM25's constants.
SHARD_DOCS, SHARD_IDS = 1024, 2_000_000
K1, B = 1.2, 0.75
#: Share of a shard's documents (one in so many) from which an id has a row of its own, and neighbours ranked first.
OFTEN, FIRST = 16, 32
#: Rows the shelves are fitted on (expected, chosen by a hash of the row), rows of them on a shelf at least,
#: numbers a document is projected to, and ids a task gets.
SAMPLE, SHELF, DIMS, TASK_IDS = 8192, 8, 16, 4_000_000


def _encode(path: str, end: int):
    @frugal
    def run(batches):
        encoder = library_encoder(path)
        for b in batches:
            for first, ids, cuts in encoder.blocks(b.column("text")):
                raw = np.insert(ids, cuts[1:], end).astype("<u4")
                cuts = cuts + np.arange(len(cuts))
                small = raw.astype("<u2") if not len(raw) or raw.max() < 1 << 16 else raw
                rows = [small[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(first, len(rows)), pa.array(np.full(len(rows), small.itemsize, np.int32)), pa.array(rows, pa.binary())],
                    names=["doc_id", "width", "ids"],
                )

    return run


def _ids(b: pa.RecordBatch):
    for width, raw in zip(b.column("width").to_pylist(), b.column("ids"), strict=True):
        yield np.frombuffer(raw.as_buffer(), f"<u{width}")


def _terms(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, id and count of every distinct id of every document, in order."""
    size = np.fromiter(map(len, docs), np.int64, len(docs))
    keys = np.repeat(np.arange(len(docs), dtype=np.int64) << 32, size)
    if len(keys):
        keys |= np.concatenate(docs)
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    found = keys[first]
    return found >> 32, found & 0xFFFFFFFF, np.diff(np.append(first, len(keys)))


def _parts(docs: list[np.ndarray], most: int = 1 << 20):
    """Runs of documents of about ``most`` ids or one document."""
    begin = held = 0
    for end, d in enumerate(docs, 1):
        held += len(d)
        if held >= most or end == len(docs):
            yield begin, docs[begin:end]
            begin, held = end, 0


@frugal
def _counts(batches):
    """Documents that hold each id; under -1 the documents, under -2 all ids."""
    held, docs, total = np.zeros(1 << 16, np.int64), 0, 0
    for b in batches:
        for _, part in _parts(list(_ids(b))):
            own = np.bincount(_terms(part)[1], minlength=len(held))
            held = np.concatenate([held, np.zeros(max(len(own) - len(held), 0), np.int64)]) + own
            docs, total = docs + len(part), total + sum(map(len, part))
    some = np.flatnonzero(held)
    yield batch(
        pa.schema([("id", pa.int64()), ("n", pa.int64())]), np.concatenate([some, [-1, -2]]), np.concatenate([held[some], [docs, total]])
    )


class Bm25:
    """What scoring needs from the corpus: a weight for each id, and the mean length."""

    def __init__(self, counts: dict[int, int]):
        docs, total = counts.get(-1, 0), counts.get(-2, 0)
        self.mean = max(total / max(docs, 1), 1.0)
        self.idf = np.zeros(max([*counts, 0]) + 1, np.float32)
        for i, n in counts.items():
            if i >= 0:
                self.idf[i] = max(0.0, np.log((docs - n + 0.5) / (n + 0.5)))
        self.signs = np.random.default_rng(DIMS).integers(0, 2, (DIMS, len(self.idf))).astype(np.float32) * 2 - 1


class Shard:
    """An inverted index over some documents' ids. Ids that many of the documents hold have a row of a table
    each instead of a list."""

    def __init__(self, docs: list[np.ndarray], stats: Bm25):
        doc, term, times = _terms(docs)
        worth = stats.idf[term]
        some = worth > 0
        doc, term, tf, worth = doc[some], term[some], times[some].astype(np.float32), worth[some]
        length = np.fromiter(map(len, docs), np.float32, len(docs))
        score = worth * tf * np.float32(K1 + 1) / (tf + np.float32(K1) * (np.float32(1 - B) + np.float32(B) * length[doc] / np.float32(stats.mean)))
        self.terms = np.split(term, np.searchsorted(doc, np.arange(1, len(docs))))
        self.size = len(docs)
        n = np.bincount(term, minlength=len(stats.idf))
        often = np.flatnonzero(n * OFTEN >= self.size)
        self.row = np.full(len(n), -1)
        self.row[often] = np.arange(len(often))
        self.table = np.zeros((len(often), self.size), np.float32)
        dense = self.row[term] >= 0
        self.table[self.row[term[dense]], doc[dense]] = score[dense]
        doc, term, score = doc[~dense], term[~dense], score[~dense]
        order = np.argsort(term, kind="stable")
        self.doc, self.score = doc[order].astype(np.int32), score[order]
        n[often] = 0
        self.n, self.first = n, np.cumsum(n) - n

    def scores(self, i: int) -> np.ndarray:
        """BM25 of every document for the distinct ids of document i."""
        own = self.terms[i]
        row = self.row[own]
        often = np.zeros(len(self.table), np.float32)
        often[row[row >= 0]] = 1
        own = own[row < 0]
        n = self.n[own]
        ends = np.cumsum(n)
        hit = np.repeat(self.first[own] - (ends - n), n)
        hit += np.arange(len(hit))
        return np.bincount(self.doc[hit], self.score[hit], self.size) + often @ self.table

    def ranked(self, i: int, unused: np.ndarray):
        """Unused documents by their score for document i, best first, ties to the earlier."""
        score = np.where(unused, self.scores(i), -1.0)
        if self.size > 4 * FIRST:
            least = np.partition(score, self.size - FIRST)[self.size - FIRST]
            best = np.flatnonzero(score >= least)
            yield from best[np.argsort(-score[best], kind="stable")].tolist()
        yield from np.argsort(-score, kind="stable").tolist()


class Shelves:
    """A kd-tree over projected documents; its leaves, from left to right, are the shelves. Each shelf has
    its first task and how many tasks share it, in proportion to the sample's rows on it."""

    def __init__(self, sample: np.ndarray, tasks: int):
        self.axis, self.cut, self.below = [], [], []
        leaves: list[tuple[int, int]] = []
        least = max(SHELF, len(sample) // (4 * tasks))

        def grow(rows: np.ndarray) -> int:
            at = len(self.axis)
            spread = np.ptp(sample[rows], axis=0) if len(rows) else np.zeros(DIMS)
            axis = int(spread.argmax())
            self.axis.append(axis)
            self.cut.append(0.0)
            self.below.append((-1, -1))
            if len(rows) >= 2 * least and spread[axis] > 0:
                x = sample[rows, axis]
                cut = np.median(x)
                cut = cut if (x < cut).any() else x[x > x.min()].min()
                self.cut[at] = float(cut)
                self.below[at] = (grow(rows[x < cut]), grow(rows[x >= cut]))
            else:
                leaves.append((at, len(rows)))
            return at

        grow(np.arange(len(sample)))
        self.axis, self.cut, self.below = np.array(self.axis), np.array(self.cut, np.float32), np.array(self.below)
        share = np.array([n for _, n in leaves], float) + 1e-9
        ends = np.cumsum(share) / share.sum() * tasks
        begins = np.concatenate([[0.0], ends[:-1]])
        self.shelf = np.full(len(self.axis), -1)
        self.shelf[[at for at, _ in leaves]] = np.arange(len(leaves))
        self.first = np.minimum(begins.astype(int), tasks - 1)
        self.shared = np.maximum(np.round(ends - begins).astype(int), 1)
        self.shared = np.minimum(self.shared, tasks - self.first)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shelf of each document, and its place there."""
        at = np.zeros(len(x), int)
        while (inner := np.flatnonzero(self.below[at, 0] >= 0)).size:
            node = at[inner]
            right = x[inner, self.axis[node]] >= self.cut[node]
            at[inner] = self.below[node, right.astype(int)]
        return self.shelf[at], x[np.arange(len(x)), self.axis[at]]


def projected(docs: list[np.ndarray], stats: Bm25) -> np.ndarray:
    """DIMS numbers of each document: its ids' BM25 weights, brought to length one, under random signs."""
    out = np.zeros((len(docs), DIMS), np.float32)
    for begin, part in _parts(docs):
        doc, term, times = _terms(part)
        weight = stats.idf[term] * (times * (K1 + 1) / (times + K1)).astype(np.float32)
        norm = np.sqrt(np.maximum(np.bincount(doc, weight**2, len(part)), 1e-12))
        for k in range(DIMS):
            out[begin : begin + len(part), k] = np.bincount(doc, weight * stats.signs[k][term], len(part)) / norm
    return out


class Filler:
    """Fills windows one after another and keeps the pieces."""

    def __init__(self, window: int, first_id: int):
        self.window, self.sequence, self.used = window, first_id, 0
        self.pieces: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray, start: int) -> int:
        """Put what fits; the position up to which the document is placed."""
        n = min(self.window - self.used, len(ids) - start)
        if n:
            raw = ids[start : start + n].astype("<u4")
            self.pieces.append([doc_id, start, n, zlib.crc32(raw), len(ids), self.sequence, self.used, raw])
            self.used += n
        if self.used == self.window:
            self.sequence, self.used = self.sequence + 1, 0
        return start + n

    def take(self, last: bool = False) -> list[tuple]:
        """Pieces of full windows; at the last call also the rest, cut at powers of two."""
        done = [p for p in self.pieces if p[5] < self.sequence]
        rest = [p for p in self.pieces if p[5] == self.sequence]
        self.pieces = rest
        if last and rest:
            self.pieces, left = [], self.used
            cut = Filler(1 << (left.bit_length() - 1), self.sequence)
            for doc_id, start, n, _, total, _, _, raw in rest:
                at = 0
                while at < n:
                    m = min(cut.window - cut.used, n - at)
                    part = raw[at : at + m]
                    done.append([doc_id, start + at, m, zlib.crc32(part), total, cut.sequence, cut.used, part])
                    at, cut.used, left = at + m, cut.used + m, left - m
                    if cut.used == cut.window and left:
                        cut.sequence, cut.used, cut.window = cut.sequence + 1, 0, 1 << (left.bit_length() - 1)
            self.sequence = cut.sequence + 1
        return done


def fill_shard(filler: Filler, ids: list, docs: list[np.ndarray], stats: Bm25) -> None:
    """Place all documents of a shard. A document that crosses into a new window is that window's seed."""
    index, unused = Shard(docs, stats), np.ones(len(docs), bool)
    ranking, seeded = iter(()), False
    for _ in docs:
        i = next((j for j in ranking if unused[j]), None)
        i = int(unused.argmax()) if i is None else i
        unused[i] = False
        before, at = filler.sequence, 0
        while at < len(docs[i]):
            at = filler.add(ids[i], docs[i], at)
        if not filler.used:
            ranking, seeded = iter(()), False
        elif not seeded or filler.sequence != before:
            ranking, seeded = index.ranked(i, unused.copy()), True


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECES = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])
PLACED = "task int, shelf int, place float, row long, doc_id long, width int, ids binary"


def _project(stats: Bm25):
    @frugal
    def run(batches):
        for b in batches:
            x = projected(list(_ids(b)), stats)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float32()))], names=["x"])

    return run


def _place(stats: Bm25, shelves: Shelves):
    @frugal
    def run(batches):
        for b in batches:
            shelf, place = shelves.place(projected(list(_ids(b)), stats))
            row = b.column("row").to_numpy()
            mixed = (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            task = shelves.first[shelf] + mixed % shelves.shared[shelf]
            yield pa.RecordBatch.from_arrays(
                [pa.array(task, pa.int32()), pa.array(shelf, pa.int32()), pa.array(place, pa.float32()), *(b.column(c) for c in ("row", "doc_id", "width", "ids"))],
                names=[c.split()[0] for c in PLACED.split(", ")],
            )

    return run


def _pack(stats: Bm25, window: int, shard_docs: int, shard_ids: int):
    def out(pieces: list[list]) -> pa.RecordBatch:
        return batch(_PIECES, *list(zip(*pieces, strict=True))[:7])

    @frugal
    def run(batches):
        filler = Filler(window, TaskContext.get().partitionId() << 40)
        ids, docs, held = [], [], 0
        for b in batches:
            for doc_id, tokens in zip(b.column("doc_id").to_pylist(), _ids(b), strict=True):
                ids.append(doc_id)
                docs.append(tokens)
                held += len(tokens)
                if len(docs) >= shard_docs or held >= shard_ids:
                    fill_shard(filler, ids, docs, stats)
                    ids, docs, held = [], [], 0
                    if done := filler.take():
                        yield out(done)
        if docs:
            fill_shard(filler, ids, docs, stats)
        if done := filler.take(last=True):
            yield out(done)

    return run


def pack(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    window: int = WINDOW,
    end: int = END,
    shard_docs: int = SHARD_DOCS,
    shard_ids: int = SHARD_IDS,
    task_ids: int = TASK_IDS,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row for each piece."""
    scratch = Scratch(spark, "packing")
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    tokens = numbered(scratch, rows.mapInArrow(_encode(path, end), "doc_id long, width int, ids binary"), "row")
    counts = tokens.select("width", "ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    known = {r.id: r.n for r in counts.collect()}  # one row for each id of the vocabulary
    n_docs, n_ids, stats = known.get(-1, 0), known.get(-2, 0), Bm25(known)
    tasks = max(1, -(-n_ids // task_ids))
    share = min(1.0, SAMPLE / max(n_docs, 1))
    some = tokens.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    sample = np.array([r.x for r in some.select("width", "ids").mapInArrow(_project(stats), "x array<float>").collect()], np.float32)
    shelves = Shelves(sample.reshape(-1, DIMS), tasks)
    placed = tokens.select("row", "doc_id", "width", "ids").mapInArrow(_place(stats, shelves), PLACED)
    dealt = placed.repartitionById(tasks, F.col("task")).sortWithinPartitions("shelf", "place", "row")
    return dealt.select("doc_id", "width", "ids").mapInArrow(_pack(stats, window, shard_docs, shard_ids), PIECES)
