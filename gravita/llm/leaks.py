"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all benchmark items.

Texts are normalised byte for byte: A-Z become small letters, all other ASCII but digits and small letters
becomes a space, so an offset in the normalised text is the same offset in the original. Words are numbered,
an item gives its windows of 10 consecutive words (all its words, if fewer), and the automaton holds the
windows as sequences of numbers. A document's words are scanned once: what the automaton reports are the ends
of windows, which become runs of hit words, and, mapped back, spans of the original text.

The benchmark's size is counted first. An automaton holds at most ``MOST`` pairs of window and item, and a word
of more than 32 bytes is held as its SHA-256, so what is broadcast is bounded; a larger benchmark is dealt to
several automata, which scan one after the other, and a document's finds are put together.

Defined results: null texts and texts without words have no words, are not hit and hit nothing; rows that
share an item_id are parts of one item; an item without an id counts as one with an empty name; repeated rows
of ``documents`` count one by one, whether or not their doc_id is null; whole texts count, however long; with no
items nothing is hit; empty tables give empty results; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, frugal, numbered

WINDOW = 10
#: Pairs of window and item that one automaton holds.
MOST = 1 << 17
#: Bytes of a word that are kept as they are.
WORD = 32
_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_SMALL = bytes(b if b in _KEEP or b > 0x7F else b + 32 if ord("A") <= b <= ord("Z") else ord(" ") for b in range(256))
_RUN = re.compile(b"[^ ]+")


def normalised(text: str | None) -> bytes:
    """As long as the text in UTF-8; words stand between spaces."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_SMALL)


def _key(word: bytes) -> bytes:
    return word if len(word) <= WORD else b" " + sha256(word).digest()


@frugal
def _windows(batches):
    schema = pa.schema([("item", pa.string()), ("window", pa.list_(pa.binary()))])
    for b in batches:
        for item, text in zip(b.column("item").to_pylist(), b.column("text"), strict=True):
            words = [_key(w) for w in normalised(text.as_py()).split()]
            for at in range(0, max(1, len(words) - WINDOW + 1), 4096):
                part = [words[i : i + WINDOW] for i in range(at, min(at + 4096, max(1, len(words) - WINDOW + 1)))]
                if words:
                    yield batch(schema, [item] * len(part), part)


class Automaton:
    """Windows as sequences of numbers; what it finds are (last word, words, items)."""

    def __init__(self, pairs: list[tuple[str, list[bytes]]]):
        self.number: dict[bytes, int] = {}
        windows: dict[tuple, list[str]] = {}
        for item, words in pairs:
            windows.setdefault(tuple(self.number.setdefault(w, len(self.number) + 1) for w in words), []).append(item)
        self.longest = max(map(len, self.number), default=0)
        self.scan = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, items in windows.items():
            self.scan.add_word(window, (len(window), tuple(items)))
        if windows:
            self.scan.make_automaton()
        self.empty = not windows

    def find(self, words: list[bytes]) -> Iterator[tuple[int, tuple[int, tuple[str, ...]]]]:
        if self.empty or not words:
            return iter(())
        number = self.number.get
        if self.longest > WORD:
            words = map(_key, words)
        return self.scan.iter(tuple(map(number, words, repeat(0))))


#: The automaton that this worker built last, and what it was built from.
_BUILT: list = [None, None]
FOUND = "node long, n_words long, items array<string>, runs array<array<long>>"


def _automaton(broadcast) -> Automaton:
    name, pairs = broadcast.value
    if _BUILT[0] != name:
        _BUILT[:] = [name, Automaton(pairs)]
    return _BUILT[1]


def _merged(runs: list[list[int]]) -> list[list[int]]:
    """Runs [first word, last word, start, end] of which none touch."""
    out: list[list[int]] = []
    for run in sorted(runs):
        if out and run[0] <= out[-1][1] + 1:
            if run[1] > out[-1][1]:
                out[-1][1], out[-1][3] = run[1], run[3]
        else:
            out.append(list(run))
    return out


def _placed(text: str, normal: bytes, words: list[list[int]]) -> list[list[int]]:
    """Runs of words with their places in the text, in characters."""
    raw, places = text.encode("utf-8", "surrogatepass"), [m.span() for m in _RUN.finditer(normal)]
    out, at, chars = [], 0, 0
    for first, last in words:
        start, end = places[first][0], places[last][1]
        begin = chars + len(raw[at:start].decode("utf-8", "surrogatepass"))
        at, chars = end, begin + len(raw[start:end].decode("utf-8", "surrogatepass"))
        out.append([first, last, begin, chars])
    return out


def _scan(broadcast):
    schema = pa.schema([("node", pa.int64()), ("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("runs", pa.list_(pa.list_(pa.int64())))])

    @frugal
    def run(batches):
        automaton = _automaton(broadcast)
        for b in batches:
            rows = []
            for text in b.column("text"):
                normal = normalised(text.as_py())
                words, items, runs = normal.split(), set(), []
                for last, (n, named) in automaton.find(words):
                    items.update(named)
                    first = last - n + 1
                    while runs and first <= runs[-1][1] + 1:  # a window that ends later may begin earlier
                        first = min(first, runs.pop()[0])
                    runs.append([first, last])
                rows.append((len(words), sorted(items), _placed(text.as_py(), normal, runs) if runs else []))
            if rows:
                yield batch(schema, b.column("node"), *zip(*rows, strict=True))

    return run


def hits(spark: SparkSession, docs: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, n_words, items, runs for each row of ``docs``: the items whose windows occur, and the runs of hit
    words as [first word, last word, start, end], the latter two in characters of the whole original text."""
    scratch = Scratch(spark, "leaks")
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text"))
    windows = scratch.write(named.mapInArrow(_windows, "item string, window array<binary>").distinct())
    rounds = max(1, -(-windows.count() // most))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def scanned(rows: DataFrame, k: int, pairs: DataFrame) -> DataFrame:
        held = [(r.item, [bytes(w) for w in r.window]) for r in pairs.collect()]  # at most ``most`` rows
        return rows.mapInArrow(_scan(spark.sparkContext.broadcast((f"{scratch.root}/{k}", held))), FOUND)

    if rounds == 1:
        return scanned(rows.withColumnRenamed("doc_id", "node"), 0, windows).withColumnRenamed("node", "doc_id")
    rows = numbered(scratch, rows, "node")
    dealt = windows.rdd.zipWithIndex()
    each = []
    for k in range(rounds):
        pairs = spark.createDataFrame(dealt.filter(lambda x, k=k: x[1] % rounds == k).map(lambda x: x[0]), windows.schema, verifySchema=False)
        each.append(scratch.write(scanned(rows.select("node", "text"), k, pairs).filter("size(items) > 0")))
    every = reduce(DataFrame.unionByName, each).groupBy("node").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.udf(_merged, "array<array<long>>")(F.flatten(F.collect_list("runs"))).alias("runs"),
    )  # as many rows of a document as there are automata
    words = rows.mapInArrow(_lengths, "node long, doc_id long, n_words long")
    none = F.array().cast("array<string>"), F.array().cast("array<array<long>>")
    return words.join(every, "node", "left").select("doc_id", "n_words", F.coalesce("items", none[0]).alias("items"), F.coalesce("runs", none[1]).alias("runs"))


@frugal
def _lengths(batches):
    schema = pa.schema([("node", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64())])
    for b in batches:
        yield batch(schema, b.column("node"), b.column("doc_id"), [len(normalised(t.as_py()).split()) for t in b.column("text")])


def spans(spark: SparkSession, docs: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, items, start, end: each passage of a document that stands in items, as characters of its text."""
    found = hits(spark, docs, items, most)
    return found.select("doc_id", "items", F.explode("runs").alias("run")).select("doc_id", "items", F.col("run")[2].alias("start"), F.col("run")[3].alias("end"))


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row for each row of ``docs``."""
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0] + 1)
    named = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return hits(spark, docs, items, most).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), named.alias("items_sha256"), (hit > 0).alias("contaminated")
    )
