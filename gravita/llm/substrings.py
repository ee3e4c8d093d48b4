"""Repeated byte strings, by a radix sort of suffixes that stops at the threshold depth.

Suffixes that share their first ``length`` bytes are the repeated windows, so no order beyond that depth
is needed. Suffixes are first distributed by an anchor: of all grams inside their first ``length`` bytes
the one with the least fingerprint, leftmost among equals. Equal windows have equal anchors at equal places,
and neighbouring suffixes share one, so this pass moves one row for about eighty suffixes. Suffixes alone
under their anchor drop out; the others meet, with the bytes they need, in a task for their anchor. There
they are dealt by their anchor's place and then sorted by most-significant-digit passes over their bytes,
eight at a time: a group whose digits agree stays as it is, any other is ordered and split, and suffixes
that stand alone drop out. Groups left at depth ``length`` are exactly the repeated windows, byte for byte,
whatever the fingerprints.

Hot groups: copies of texts that make up a large share of the table are found by heavy-hitter summaries
and decided where they are read, one copy standing for all. An anchor with more than ``crowd`` suffix
rows is not gathered: its windows become rows that are counted with map-side combining, told apart by two
64-bit fingerprints of their halves. The few that make up a large share of those rows are broadcast.

Defined results: null and empty texts have no bytes; texts shorter than ``length`` lose nothing; very long
texts are worked through in blocks; matches never cross documents; rows that repeat a doc_id or have none
are documents of their own, repeated rows each other's copies; null doc_ids stay null; an empty table gives
an empty result; other columns, whatever their names, are not read (``drop_repeats`` keeps them).
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, frugal
from .exact import heavy_digests

LENGTH = 200
GRAM = 40
CROWD = 16384
#: Share of a crowd's windows (one in so many) from which a window is met where it is read.
HOT = 2048
#: Suffixes of a text, and bytes of contexts, handled at once.
BLOCK = 1 << 19
_KEY = ["key", "mark"]
_NULL_ID = -(1 << 63)


class Fingerprints:
    """Fingerprints of all strings of one length in a buffer, from prefix sums modulo 2**64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.byte = rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = (int(rng.integers(0, 1 << 60)) * 8 + 3) % (1 << 64)
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n + n // 8, 1 << 16)
            self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, self.base, np.uint64)]))
            self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, self.inverse, np.uint64)]))

    def sums(self, a: np.ndarray) -> np.ndarray:
        self._powers(len(a) + 1)
        out = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(self.byte[a] * self.up[: len(a)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        return mixed((sums[starts + n] - sums[starts]) * self.down[starts])

    def all(self, a: np.ndarray, n: int) -> np.ndarray:
        s = self.sums(a)
        m = len(a) - n + 1
        return mixed((s[n:] - s[:-n]) * self.down[:m])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Least of every w values in a row, in three passes whatever w is."""
    n = len(v)
    full = np.full(-(-n // w) * w, np.iinfo(v.dtype).max, v.dtype)
    full[:n] = v
    blocks = full.reshape(-1, w)
    front = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], front[w - 1 : n])


_GRAMS, _LEFT, _RIGHT = Fingerprints(11), Fingerprints(12), Fingerprints(13)


def anchors(a: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint of each anchor in order, the first and last suffix that has it, and its place. Long texts
    are worked through in blocks of suffixes; an anchor whose suffixes lie in two blocks is given twice."""
    parts = [(at, _anchors(a[at : at + BLOCK + length - 1], length, gram)) for at in range(0, len(a) - length + 1, BLOCK)]
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate([p[k] + (at if k else 0) for at, p in parts]) for k in range(4))


def _anchors(a: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    g = _GRAMS.all(a, gram)
    least = sliding_min((g & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64), length - gram + 1)
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
    return g[place[first]].view(np.int64), first, np.concatenate([first[1:], [len(place)]]) - 1, place[first]


def _bytes(texts: pa.Array):
    """A byte view of each text of a column; null counts as empty."""
    for t in texts:
        yield np.frombuffer(t.as_buffer() or b"", np.uint8) if t.is_valid else np.zeros(0, np.uint8)


def _anchor_rows(length: int, gram: int):
    schema = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("mark", pa.int64()), ("times", pa.int32())])

    @frugal
    def run(batches):
        for b in batches:
            out: list[list] = [[], [], [], []]
            held = 0
            for a, key, mark in zip(_bytes(b.column("text")), b.column("key").to_pylist(), b.column("mark").to_pylist(), strict=True):
                h, times = np.unique(anchors(a, length, gram)[0], return_counts=True)
                for column, x in zip(out, (h, np.full(len(h), key, np.int64), np.full(len(h), mark, np.int64), times.astype(np.int32)), strict=True):
                    column.append(x)
                held += len(h)
                if held > 100_000:
                    yield batch(schema, *map(np.concatenate, out))
                    out, held = [[], [], [], []], 0
            if held:
                yield batch(schema, *map(np.concatenate, out))

    return run


CONTEXT = "anchor long, key long, mark long, at int, n int, gap int, bytes binary"
_CONTEXT = pa.schema(
    [("anchor", pa.int64()), ("key", pa.int64()), ("mark", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("gap", pa.int32()), ("bytes", pa.binary())]
)


def _contexts(length: int, gram: int):
    """For each wanted anchor of a text: its first suffix, how many have it, how far behind the first suffix
    it begins, and the bytes they need."""

    @frugal
    def run(batches):
        for b in batches:
            out, held = [], 0
            rows = zip(_bytes(b.column("text")), b.column("key").to_pylist(), b.column("mark").to_pylist(), b.column("anchors"), strict=True)
            for a, key, mark, wanted in rows:
                h, first, last, place = anchors(a, length, gram)
                hit = np.flatnonzero(np.isin(h, wanted.values.to_numpy()))
                raw = a.tobytes()
                for x, i, j, p in zip(h[hit].tolist(), first[hit].tolist(), last[hit].tolist(), place[hit].tolist(), strict=True):
                    out.append((x, key, mark, i, j - i + 1, p - i, raw[i : j + length]))
                    held += j - i + length
                    if held > 4 << 20:
                        yield batch(_CONTEXT, *zip(*out, strict=True))
                        out, held = [], 0
            if out:
                yield batch(_CONTEXT, *zip(*out, strict=True))

    return run


def _laid(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a batch of contexts, where each context's begin and the last end, and of every suffix
    its row and how many suffixes of the row come before it."""
    column = b.column("bytes")
    cuts = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    n = b.column("n").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    return np.frombuffer(column.buffers()[2], np.uint8), cuts, row, np.arange(len(row)) - (np.cumsum(n) - n)[row]


def _windows(b: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in its text and fingerprints of both halves of every window of a batch of contexts, taken
    of a block of rows at a time."""
    half = length // 2
    raw, cuts, row, step = _laid(b)
    n = np.bincount(row, minlength=b.num_rows)
    ends = np.cumsum(n)
    left, right = np.empty(len(row), np.uint64), np.empty(len(row), np.uint64)
    i = 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + BLOCK, side="right")) - 1)
        own = slice(int(ends[i] - n[i]), int(ends[j - 1]))
        part, start = raw[cuts[i] : cuts[j]], cuts[:-1][row[own]] - cuts[i] + step[own]
        left[own] = _LEFT.at(_LEFT.sums(part), start, half)
        right[own] = _RIGHT.at(_RIGHT.sums(part), start + half, length - half)
        i = j
    return row, b.column("at").to_numpy().astype(np.int64)[row] + step, left, right


def _grouped(new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From flags of where groups begin: which items have company, and of those the group and each group's first."""
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, len(new)))
    kept, size = np.repeat(size > 1, size), size[size > 1]
    return kept, np.repeat(np.arange(len(size)), size), np.cumsum(size) - size


def equal_suffixes(raw: np.ndarray, start: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Indices, in order of their bytes, of the suffixes whose first ``length`` bytes another one of the same
    first digit has too. Digits after the first are eight bytes (fewer for a shorter length)."""
    order = np.argsort(first, kind="stable")
    digit = first[order]
    kept, group, heads = _grouped(np.concatenate([[True], digit[1:] != digit[:-1]])[: len(digit)])
    order = order[kept]
    width = next(w for w in (8, 4, 2, 1) if w <= length)
    view = np.ndarray(max(len(raw) - width + 1, 0), f">u{width}", raw, strides=(1,))
    for depth in [*range(0, length - width, width), length - width]:
        if not len(order):
            break
        digit = view[start[order] + depth].astype(np.uint64)
        apart = digit != digit[heads][group]
        if not apart.any():
            continue
        mixed_ = np.flatnonzero(np.logical_or.reduceat(apart, heads)[group])
        put = mixed_[np.lexsort((digit[mixed_], group[mixed_]))]
        order[mixed_], digit[mixed_] = order[put], digit[put]
        kept, regrouped, heads = _grouped(np.concatenate([[True], (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])]))
        order, group = order[kept], regrouped
    return order


_SPANS = pa.schema([("key", pa.int64()), ("mark", pa.int64()), ("begin", pa.int32()), ("end", pa.int32())])


def _repeated(b: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Spans covered by the repeated windows of complete anchor groups."""
    raw, cuts, row, step = _laid(b)
    anchor = b.column("anchor").to_numpy()
    group = np.cumsum(np.concatenate([[False], anchor[1:] != anchor[:-1]]))
    first = group[row] * length + b.column("gap").to_numpy()[row] - step
    place = b.column("at").to_numpy().astype(np.int64)[row] + step
    hit = np.sort(equal_suffixes(raw, cuts[:-1][row] + step, first, length))
    new = np.flatnonzero((np.diff(row[hit]) != 0) | (np.diff(place[hit]) != 1)) + 1 if len(hit) else []
    begin = hit[np.concatenate([[0], new]).astype(int)] if len(hit) else hit
    final = hit[np.concatenate([np.array(new) - 1, [len(hit) - 1]]).astype(int)] if len(hit) else hit
    keys, marks = b.column("key").to_numpy(), b.column("mark").to_numpy()
    return batch(_SPANS, keys[row[begin]], marks[row[begin]], place[begin].astype(np.int32), (place[final] + length).astype(np.int32))


def _cut(b: pa.RecordBatch):
    """Parts of about BLOCK bytes of contexts, cut between anchors."""
    if not b.num_rows:
        return
    column, a = b.column("bytes"), b.column("anchor").to_numpy()
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    new = np.concatenate([np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])), [len(a)]])
    begin = 0
    while begin < len(a):
        end = int(new[max(np.searchsorted(at[new], at[begin] + BLOCK, side="right") - 1, np.searchsorted(new, begin, side="right"))])
        yield b.slice(begin, end - begin)
        begin = end


def _by_anchor(length: int):
    """Streams a partition sorted by anchor, holding one batch and the group that it ends in."""

    @frugal
    def run(batches):
        rest = None
        for b in batches:
            if rest is not None:
                b = pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0]
            a = b.column("anchor").to_numpy()
            if not len(a):
                continue
            cut = int(np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))[-1])
            yield from (_repeated(part, length) for part in _cut(b.slice(0, cut)))
            rest = b.slice(cut)
        if rest is not None and rest.num_rows:
            yield _repeated(rest, length)

    return run


def _crowd_rows(length: int):
    schema = pa.schema([("key", pa.int64()), ("mark", pa.int64()), ("begin", pa.int32()), ("left", pa.int64()), ("right", pa.int64())])

    @frugal
    def run(batches):
        for b in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
            row, place, left, right = _windows(b, length)
            keys, marks = b.column("key").to_numpy(), b.column("mark").to_numpy()
            yield batch(schema, keys[row], marks[row], place.astype(np.int32), left.view(np.int64), right.view(np.int64))

    return run


def _split_copies(docs: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """(rows to search, rows of heavy groups): of each heavy group one row is in both."""
    rows = docs.select(
        *more, "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    heavy = heavy_digests(rows.select("digest"))
    winners = (
        rows.select("digest", "key").join(F.broadcast(heavy), "digest", "left_semi")
        .groupBy("digest").agg(F.max("key").alias("winner"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    )
    marked = rows.join(F.broadcast(winners), "digest", "left").withColumn("mark", F.xxhash64("text"))
    return marked.filter("winner IS NULL OR key = winner"), marked.filter("winner IS NOT NULL")


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """key, mark, spans (array of begin, end): what the repeated windows of the rows to search cover."""
    scratch = Scratch(spark, "repeats")
    search, _ = _split_copies(docs)
    rows = search.select(*_KEY, "text")
    found = scratch.write(rows.mapInArrow(_anchor_rows(length, gram), "anchor long, key long, mark long, times int"))
    often = found.groupBy("anchor").agg(F.sum("times").alias("total")).filter("total > 1")
    wanted = (
        found.join(often, "anchor")
        .groupBy(*_KEY, (F.col("total") > crowd).alias("crowded"))
        .agg(F.collect_set("anchor").alias("anchors"))
    )
    wanted = scratch.write(wanted)
    scratch.drop(found)

    def contexts(crowded: bool) -> DataFrame:
        own = wanted.filter(F.col("crowded") == crowded).drop("crowded")
        return rows.join(own, _KEY).mapInArrow(_contexts(length, gram), CONTEXT)

    spans = contexts(False).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _by_anchor(length), "key long, mark long, begin int, end int"
    )
    if not wanted.filter("crowded").isEmpty():
        windows = contexts(True).mapInArrow(_crowd_rows(length), "key long, mark long, begin int, left long, right long")
        windows = scratch.write(windows)
        window = ["left", "right"]
        again = scratch.write(windows.groupBy(*window).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        hot = F.broadcast(again.filter(F.col("n") * HOT >= windows.count()).select(*window))  # at most HOT rows
        met = windows.join(hot, window, "left_semi").unionByName(windows.join(hot, window, "left_anti").join(again.select(*window), window).select(windows.columns))
        spans = spans.unionByName(met.select(*_KEY, "begin", (F.col("begin") + length).alias("end")))
    out = scratch.write(spans.groupBy(*_KEY).agg(F.collect_set(F.struct("begin", "end")).alias("spans")))
    scratch.drop(wanted)
    return out


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs that the spans cover."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans or []):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> bytes:
    raw, at, kept = text.encode(), 0, []
    for begin, end in spans:
        kept.append(raw[at:begin])
        at = end
    return b"".join([*kept, raw[at:]])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


@frugal
def _digest(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    for b in batches:
        spans = [merged(s) for s in b.column("spans").to_pylist()]
        texts = b.column("text").to_pylist()
        kept = [_without(t, s) for t, s in zip(texts, spans, strict=True)]
        removed = [sum(e - s for s, e in x) for x in spans]
        yield batch(schema, b.column("doc_id"), [len(k) + r for k, r in zip(kept, removed, strict=True)], removed, list(map(len, spans)), [sha256(k).hexdigest() for k in kept])


def removed_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row for each row of ``docs``."""
    spans = repeated_spans(spark, docs, length, gram, crowd)
    search, copies = _split_copies(docs)
    single = search.filter("winner IS NULL").select("doc_id", *_KEY, "text").join(spans, _KEY, "left").select("doc_id", "text", "spans")
    n = F.octet_length("text").cast("long")
    whole = n >= length
    hot = copies.select(
        F.col("doc_id").cast("long"),
        n.alias("n_bytes"),
        F.when(whole, n).otherwise(0).cast("long").alias("n_removed"),
        whole.cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(b""), 256)).otherwise(F.lower(F.hex("digest"))).alias("kept_sha256"),
    )
    return single.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(_digest, RESULT).unionByName(hot)


def drop_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``docs`` with all columns, ``text`` without its repeated windows and ``n_chars``, if there, of what
    is left. A character that is cut inside goes wholly; a document may be left empty. Null texts that
    lose nothing stay null."""
    spans = repeated_spans(spark, docs, length, gram, crowd)
    schema = docs.schema
    at, counted = schema.names.index("text"), schema.names.index("n_chars") if "n_chars" in schema.names else None

    @frugal
    def run(batches):
        for b in batches:
            held = b.column("row").flatten()
            whole = b.column("whole").to_pylist()
            kept = [
                t if t is None or not (w or s) else "" if w else _without(t, merged(s)).decode("utf-8", "ignore")
                for t, s, w in zip(held[at].to_pylist(), b.column("spans").to_pylist(), whole, strict=True)
            ]
            if counted is not None:
                n = [len(k) if k is not None and (w or s) else c for k, c, s, w in zip(kept, held[counted].to_pylist(), b.column("spans").to_pylist(), whole, strict=True)]
                held[counted] = pa.array(n, held[counted].type)
            held[at] = pa.array(kept, held[at].type)
            yield pa.RecordBatch.from_arrays(held, names=schema.names)

    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    search, copies = _split_copies(rows, "row")
    single = search.filter("winner IS NULL").select("row", *_KEY).join(spans, _KEY, "left").select("row", "spans", F.lit(False).alias("whole"))
    hot = copies.select("row", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), (F.octet_length("text") >= length).alias("whole"))
    return single.unionByName(hot).mapInArrow(run, schema)
