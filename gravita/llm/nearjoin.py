"""Near-duplicates: a multi-index Hamming join over MinHash signatures, confirmed on full shingle sets.

A signature has 30 symbols of 24 bits, taken from the minima of a set under 30 orders. It is split into 10
chunks of 3 symbols. Two signatures that differ in at most 19 symbols have, by pigeonhole, a chunk with at
most one error; every chunk therefore enumerates its three ways of leaving one symbol out, and the two
symbols left are, bit for bit, a bucket's name. So every pair within distance 19 meets, whatever the data.
Sets at similarity 0.75 differ in 7.5 symbols on average, and in more than 19 with a probability under 2e-6.

Equal sets are one node from the start. Links are confirmed on full sets, in two rounds:
1. every member of a bucket meets the bucket's least member. What is confirmed gives components, so that
   thousands of near-copies become one component by rows in proportion to their number;
2. buckets that still hold several components are searched exactly. A set can reach the similarity only if
   that share of its own shingles occurs in sets of other components, so sets without that support are set
   aside, as often as that sets any aside. The sets left in such a bucket meet in blocks of bounded size,
   and a block returns only links that join components: rows follow members, never pairs.
A pair inside one component needs no link, so nothing is lost. Hot buckets are split: their least members
come from map-side combining, their members are joined by splittable joins and dealt to blocks by hash.

Defined results: every row is a document of its own, whether or not its doc_id is null or repeated; a null
doc_id counts as larger than any other, and component_id is null where all of a component are null; texts
without words, null and empty ones are linked with nothing; whole texts count, however long; repeated rows
and ties need no rule, as all of a component get its smallest doc_id; an empty table gives an empty result;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, frugal, numbered
from .components import components
from .shingles import Orders, mixed, set_digest, shingles

SYMBOLS, CHUNK, DISTANCE, BITS = 30, 3, 19, 24
#: Percent of the union that the intersection must reach.
PERCENT = 75
#: Sets that meet one leader in a task, and shingles in a block, about.
VISITORS, BLOCK = 256, 1 << 19
#: Column that tells rows apart.
ROW = "_row"
_ORDERS = Orders(SYMBOLS)
_PAIRS = pa.schema([("u", pa.int64()), ("v", pa.int64())])
SETS = "node long, n long, a long, b long, signature binary"


def signature(s: np.ndarray) -> np.ndarray:
    """SYMBOLS symbols of BITS bits of a filled set."""
    return (mixed(_ORDERS.minima(s)) & np.uint64((1 << BITS) - 1)).astype("<u4")


@frugal
def _sets(batches):
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("signature", pa.binary())])
    for b in batches:
        rows = []
        for text in b.column("text"):
            s = shingles(text.as_py())
            rows.append((len(s), *set_digest(s), signature(s).tobytes() if len(s) else b""))
        if rows:
            yield batch(schema, b.column("node"), *zip(*rows, strict=True))


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, SYMBOLS)


def buckets(signatures: np.ndarray) -> np.ndarray:
    """The names of each signature's buckets: which symbols they hold, and those symbols."""
    chunks = signatures.astype(np.int64).reshape(len(signatures), -1, CHUNK)
    spot, out = np.arange(chunks.shape[1], dtype=np.int64) * CHUNK, []
    for left_out in range(CHUNK):
        x, y = (chunks[:, :, i] for i in range(CHUNK) if i != left_out)
        out.append(((spot + left_out) << (2 * BITS)) | (x << BITS) | y)
    return np.concatenate(out, 1)


@frugal
def _bucket_rows(batches):
    schema = pa.schema([("bucket", pa.int64()), ("node", pa.int64())])
    for b in batches:
        for at in range(0, b.num_rows, 4096):
            part = b.slice(at, 4096)
            found = buckets(_signatures(part.column("signature")))
            yield batch(schema, found.ravel(), np.repeat(part.column("node").to_numpy(), found.shape[1]))


@frugal
def _within(batches):
    """Pairs whose sizes allow the similarity and whose signatures are within the distance."""
    for b in batches:
        if b.num_rows:
            x, y = b.column("n_u").to_numpy(), b.column("n_v").to_numpy()
            ok = 100 * np.minimum(x, y) >= PERCENT * np.maximum(x, y)
            ok &= (_signatures(b.column("s_u")) != _signatures(b.column("s_v"))).sum(1) <= DISTANCE
            yield batch(_PAIRS, b.column("u").to_numpy()[ok], b.column("v").to_numpy()[ok])


def _reaches(shared: np.ndarray | int, x: np.ndarray | int, y: np.ndarray | int):
    return 100 * shared >= PERCENT * (x + y - shared)


@frugal
def _led(batches):
    """Confirmed links of rows sorted by leader, part and side: a leader's text, then those that meet it."""
    leader, own = None, None
    for b in batches:
        u, v = [], []
        for at, side, node, text in zip(b.column("u").to_pylist(), b.column("side").to_pylist(), b.column("node").to_pylist(), b.column("text"), strict=True):
            s = shingles(text.as_py())
            if side == 0:
                leader, own = at, s
            elif at == leader:
                place = np.minimum(np.searchsorted(own, s), len(own) - 1)
                if _reaches(int((own[place] == s).sum()), len(own), len(s)):
                    u.append(at)
                    v.append(node)
        yield batch(_PAIRS, u, v)


def _confirmed(scratch: Scratch, texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of pairs (u, v) those whose full sets reach the similarity. The sets that meet one u are split, and
    each part gets u's text once."""
    parts = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("long").alias("parts"))
    visitors = pairs.join(parts, "u").select("u", F.pmod(F.xxhash64("v"), "parts").alias("part"), F.lit(1).alias("side"), F.col("v").alias("node"))
    leaders = parts.select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"), F.col("u").alias("node"))
    rows = visitors.unionByName(leaders).join(texts, "node")
    met = rows.repartition("u", "part").sortWithinPartitions("u", "part", "side", "node")
    return scratch.write(met.select("u", "side", "node", "text").mapInArrow(_led, "u long, v long"))


@frugal
def _members(batches):
    """A row for each shingle of each set."""
    schema = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("component", pa.int64())])
    for b in batches:
        nodes, of, texts = b.column("node").to_numpy(), b.column("component").to_numpy(), b.column("text")
        out, held, begin = [], 0, 0
        for i, text in enumerate(texts):
            out.append(shingles(text.as_py()).view(np.int64))
            held += len(out[-1])
            if held > 1 << 17 or i + 1 == len(texts):
                size = [len(x) for x in out]
                yield batch(schema, np.concatenate(out), np.repeat(nodes[begin : i + 1], size), np.repeat(of[begin : i + 1], size))
                out, held, begin = [], 0, i + 1


def _supported(scratch: Scratch, texts: DataFrame, named: DataFrame, rounds: int = 4) -> DataFrame:
    """node, component, n of the sets that have enough of their shingles in sets of other components.

    named: node, component, n."""
    members = scratch.write(texts.join(named, "node").select("node", "component", "text").mapInArrow(_members, "shingle long, node long, component long"))
    left, before = scratch.write(named), None
    for _ in range(rounds):
        here = members if before is None else members.join(left.select("node"), "node", "left_semi")
        spread = here.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("shingle")
        shared = here.join(spread, "shingle").groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
        kept = scratch.write(left.join(shared, "node").filter(F.col("shared") * 100 >= F.col("n") * PERCENT).select("node", "component", "n"))
        scratch.drop(left)
        left, before, now = kept, now if before is not None else -1, kept.count()
        if now == before or not now:
            break
    scratch.drop(members)
    return left


@frugal
def _joining(batches):
    """Links that join components, of rows sorted by bucket and block: sets of a block are held together."""
    rows: list[tuple] = []

    def links():
        sets = [shingles(t) for *_, t in rows]
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        members, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        order = np.argsort(members, kind="stable")
        members, of = members[order], of[order]
        _, label = np.unique([r[2] for r in rows], return_inverse=True)
        u, v = [], []
        for i, own in enumerate(sets):
            a, b = np.searchsorted(members, own, "left"), np.searchsorted(members, own, "right")
            n = b - a
            ends = np.cumsum(n)
            shared = np.bincount(of[np.repeat(a - (ends - n), n) + np.arange(int(ends[-1]))], minlength=len(sets))
            for j in np.flatnonzero(_reaches(shared, size, len(own)) & (label != label[i])):
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
                    u.append(rows[i][1])
                    v.append(rows[j][1])
        return batch(_PAIRS, u, v)

    spot = None
    for b in batches:
        for key, node, component, text in zip(
            zip(*(b.column(c).to_pylist() for c in ("bucket", "i", "j")), strict=True), b.column("node").to_pylist(), b.column("component").to_pylist(), b.column("text").to_pylist(), strict=True
        ):
            if key != spot and rows:
                yield links()
                rows = []
            spot = key
            rows.append((key, node, component, text))
    if rows:
        yield links()


def _several(labelled: DataFrame) -> DataFrame:
    """Rows (bucket, node, component, n) of the buckets that hold several components."""
    spread = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.sum("n").alias("held")).filter("x < y")
    return labelled.join(spread.select("bucket", "held"), "bucket")


def _exhausted(scratch: Scratch, texts: DataFrame, labelled: DataFrame) -> DataFrame:
    """Links between components, of all sets that share a bucket. A bucket's sets are dealt to blocks, and
    every two blocks meet."""
    rows = _several(labelled).withColumn("blocks", F.ceil(F.col("held") / BLOCK).cast("long")).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = rows.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "component")
    met = met.join(texts, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    return scratch.write(met.mapInArrow(_joining, "u long, v long").distinct())


def _edges(found: DataFrame) -> DataFrame:
    return found.select(F.col("node").alias("u"), F.col("component").alias("v"))


def classes(scratch: Scratch, docs: DataFrame) -> DataFrame:
    """node, n_shingles, component: the least node that links reach, for every row (node, text) of a written
    table whose nodes are unique."""
    sets = scratch.write(docs.select("node", "text").mapInArrow(_sets, SETS))
    same = ["n", "a", "b"]
    filled = sets.filter("n > 0")
    nodes = scratch.write(filled.groupBy(*same).agg(F.min("node").alias("node"), F.first("signature").alias("signature")))
    rows = scratch.write(nodes.select("node", "signature").mapInArrow(_bucket_rows, "bucket long, node long"))
    leaders = rows.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last").select("bucket", "leader")
    led = scratch.write(rows.join(leaders, "bucket").select("bucket", "node", "leader"))
    scratch.drop(rows)
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}"))
    stars = led.filter("leader <> node").select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct()
    stars = scratch.write(stars.join(side("u"), "u").join(side("v"), "v").mapInArrow(_within, "u long, v long"))
    texts = scratch.write(docs.select("node", "text").join(led.select("node").distinct(), "node", "left_semi"))
    first = scratch.write(components(scratch, _confirmed(scratch, texts, stars)))
    named = nodes.select("node", "n").join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = scratch.write(_several(led.select("bucket", "node").join(named, "node")).select("bucket", "node", "component", "n"))
    left = _supported(scratch, texts, labelled.select("node", "component", "n").distinct())
    more = _exhausted(scratch, texts, labelled.join(left.select("node"), "node", "left_semi"))
    final = scratch.write(components(scratch, _edges(first).unionByName(more)))
    scratch.drop(led, stars, texts, labelled, left)
    own = nodes.join(final, "node", "left").select(*same, F.coalesce("component", "node").alias("component"))
    full = filled.drop("signature").join(own, same).select("node", F.col("n").alias("n_shingles"), "component")
    return full.unionByName(sets.filter("n = 0").select("node", F.col("n").alias("n_shingles"), F.col("node").alias("component")))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``."""
    scratch = Scratch(spark, "near")
    rows = numbered(scratch, docs.select(F.col("doc_id").cast("long"), "text"), "node")
    found = scratch.write(classes(scratch, rows).join(rows.select("node", "doc_id"), "node"))
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.join(least, "component").select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which each component keeps one, with all their columns, whatever their names. Every
    row is a document of its own: the smallest id stays, a null id counts as the largest, and of rows that share it
    any one."""
    scratch = Scratch(spark, "near-rows")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = numbered(scratch, docs.select(whole), ROW)
    found = classes(scratch, rows.select(F.col(ROW).alias("node"), F.col("row.text").alias("text"))).select(F.col("node").alias(ROW), "component")
    members = found.join(rows.select(ROW, F.col("row.doc_id").alias("doc_id")), ROW)
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(ROW))
    first = members.groupBy("component").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    left = Scratch(spark, "near-gone")
    gone = left.write(members.join(first, "component").filter(F.col(ROW) != F.col(f"first.{ROW}")).select(ROW))
    scratch.drop_all(rows)
    return rows.join(gone, ROW, "left_anti").select("row.*")
