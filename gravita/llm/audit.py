"""What an order of filters removes: an audit of five filters in every order they can be applied in.

Each row becomes a mask with a bit for each filter it fails. Four bits follow from the row itself. The fifth,
whether a smaller id holds the same text, is decided by a fingerprint-routed RDD: rows are partitioned by the
xxhash of their text and sorted by it and by their id, so that a task holds one fingerprint's chain at a time.
A chain keeps the full text of each different text of the fingerprint with its minimum id, which comes first;
later rows of that text leave with the fifth bit. Copies that meet where they are read are settled there: only
the smallest id of a block's equal texts is routed with the text, the others go anywhere. So a text that makes
up a third of all rows reaches its chain once for each block that was read.

Masks are then counted: ``combineByKey`` merges, for each part, one vector of counts by mask, and counts of the
good and the toxic among them. All orders and steps are linear in that vector.

Defined results: null text counts as empty, null source as the empty part; a null doc_id counts as larger than
any other, so its row is a copy wherever a row with an id holds the text, and of rows that only have null ids
none is; rows that repeat a doc_id count one by one, and are no copies of each other; a document counts as good
(toxic) once, if any of its labels says so; ids without a label are neither; an empty table gives an empty
result; other columns, whatever their names, are not read. Whole texts count, however long.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

LETTERS = "ABCDE"
COPY = 1 << LETTERS.index("E")
MASKS = 1 << len(LETTERS)
#: Bytes of text that a task keeps to settle copies where they are read.
BLOCK = 32 << 20
UPPER = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"
#: Bytes that begin a code point.
LEADING = bytes(b for b in range(256) if b & 0xC0 != 0x80)
ORDERS = ["".join(p) for p in permutations(LETTERS)]


def own_mask(text: bytes) -> int:
    """Bits of the filters that need only the text: A too short, B repetitive, C shouting, D marks."""
    words = text.split()  # bytes are split at \x20 and \x09-\x0d alone
    points = len(text) - len(text.translate(None, LEADING))
    failed = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * (len(text) - len(text.translate(None, UPPER))) > 2 * points,
        len(text.translate(None, MARKS)) < len(text),
    )
    return sum(1 << i for i, f in enumerate(failed) if f)


def _rank(doc_id: int | None) -> tuple[bool, int]:
    return doc_id is None, doc_id or 0


def settled(rows, block: int = BLOCK):
    """((route, open, null id, id), (part, mask, rows, text)) of rows (doc_id, part, text).

    Open records hold a text that may yet have a smaller id elsewhere; the others are decided and carry none."""
    held: dict[bytes, tuple] = {}
    late: dict[tuple, int] = {}
    size = 0

    def settle(rank, parts, mask):
        for part, n in parts.items():
            key = rank, part, mask | COPY
            late[key] = late.get(key, 0) + n

    def sent():
        for (rank, part, mask), n in late.items():
            yield (xxhash.xxh64_intdigest(f"{part}\0{rank[1]}"), 0, *rank), (part, mask, n, None)
        for text, (rank, mask, parts) in held.items():
            route = xxhash.xxh64_intdigest(text)
            for part, n in parts.items():
                yield (route, 1, *rank), (part, mask, n, text)

    for doc_id, part, text in rows:
        text, rank = (text or "").encode("utf-8", "surrogatepass"), _rank(doc_id)
        size += 200
        if text not in held:
            held[text] = rank, own_mask(text), {part: 1}
            size += len(text)
        else:
            least, mask, parts = held[text]
            if rank > least:
                settle(rank, {part: 1}, mask)
            elif rank == least:
                parts[part] = parts.get(part, 0) + 1
            else:
                settle(least, parts, mask)
                held[text] = rank, mask, {part: 1}
        if size > block:
            yield from sent()
            held, late, size = {}, {}, 0
    yield from sent()


def chained(records):
    """(doc_id, part, mask, rows) of sorted records: all but the rows of a text's minimum id get the copy's bit."""
    route, chain = None, {}
    for (at, is_open, null, value), (part, mask, n, text) in records:
        doc_id = None if null else value
        if is_open:
            if at != route:
                route, chain = at, {}
            least = chain.setdefault(text, (null, value))
            mask |= COPY if (null, value) > least else 0
        yield doc_id, part, mask, n


def masks(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """doc_id, part, mask, n: the rows of ``docs`` by what they fail, equal rows counted. There are as many
    partitions of chains as the texts' bytes ask for."""
    part = F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), part, F.col(text_col).alias("text"))
    held = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 200), F.lit(0))).first()[0]
    parts = max(-(-held // (2 * BLOCK)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    routed = rows.rdd.mapPartitions(settled).repartitionAndSortWithinPartitions(parts, partitionFunc=lambda key: key[0])
    found = spark.createDataFrame(routed.mapPartitions(chained), "doc_id long, part string, mask int, n long", verifySchema=False)
    return Scratch(spark, "audit").write(found)


def weights() -> np.ndarray:
    """For each order and step the numbers that make kept, removed, redundant, unique_fails and shapley of counts by mask."""
    mask = np.arange(MASKS)
    bits = np.array([bin(m).count("1") for m in mask])
    share = np.array([0, *(len(ORDERS) // b for b in range(1, len(LETTERS) + 1))])[bits]
    out = np.zeros((len(ORDERS), len(LETTERS), 5, MASKS), np.int64)
    for i, order in enumerate(ORDERS):
        before = 0
        for j, letter in enumerate(order):
            own = 1 << LETTERS.index(letter)
            fails, gone = mask & own != 0, mask & before != 0
            out[i, j] = ~(gone | fails), fails & ~gone, fails & gone, mask == own, fails * share
            before |= own
    return out


def _vector(row) -> np.ndarray:
    return _add(np.zeros((3, MASKS), np.int64), row)


def _add(vector: np.ndarray, row) -> np.ndarray:
    mask, n, good, toxic = row
    vector[:, mask] += n, n * good, n * toxic
    return vector


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a += b
    return a


def _steps(of):
    """The rows of one part."""
    part, (every, good, toxic) = of
    table = weights()
    counts, good_lost, toxic_lost = table @ every, table[:, :, 1] @ good, table[:, :, 1] @ toxic
    for i, order in enumerate(ORDERS):
        for j in range(len(LETTERS)):
            kept, removed, redundant, unique, shapley = map(int, counts[i, j])
            yield part, order, j + 1, kept, removed, redundant, unique, int(good_lost[i, j]), int(toxic_lost[i, j]), shapley


RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def interactions(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """A row for each part, order of the filters and step; what each column counts stands in ``RESULT``."""
    rows = masks(spark, docs, id_col, text_col, part_col).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(c)
    said = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_one("quality"), is_one("toxic"))
    named = rows.join(said, "doc_id", "left").select("part", "mask", "n", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    vectors = named.rdd.map(lambda r: (r[0], r[1:])).combineByKey(_vector, _add, _merge)
    return spark.createDataFrame(vectors.flatMap(_steps), RESULT, verifySchema=False)
