"""BPE encoding and decoding without merging step by step.

A word's bytes run through an Aho-Corasick automaton of all tokens, which gives the longest token at
every position. The encoder goes left to right with that token; two neighbours may stand together only
if merging their bytes in rank order would leave that very boundary, which depends on the pair alone and
is remembered in a table. If they may not, the next shorter token is tried, and if none is left the
encoder steps back; a bit for each position keeps it from coming there again, so the time is linear.
Decoding gathers bytes from one table of all tokens by their offsets.

Defined results: null counts as empty and has no ids; the texts of added tokens become those tokens;
bytes that are not UTF-8 decode to the replacement character; whole texts are encoded, however long; rows
that repeat a doc_id or have none are encoded one by one; ties cannot occur; an empty table gives an empty
result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, frugal
from .tokens import PieceEncoder

#: Fixed value: how byte-level BPE cuts text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: visible Latin-1
    characters for themselves, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256))
    return [chr(b) if b in shown else chr(256 + next(hidden)) for b in range(256)]


class Bpe:
    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        vocab = said["model"]["vocab"]
        self.letters = byte_letters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in said["model"]["merges"]]
        words = [*sorted(self.letters, key=vocab.__getitem__), *dict.fromkeys(a + b for a, b in merges)]
        rank = {w: i for i, w in enumerate(words)}
        self.id_of = np.array([vocab[w] for w in words], "<u4")
        self.halves = [(i, i) for i in range(256)] + [(-1, -1)] * (len(words) - 256)
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in merges:
            pair, whole = (rank[a], rank[b]), rank[a + b]
            if pair not in self.merged:
                self.merged[pair] = whole
                if self.halves[whole][0] < 0:
                    self.halves[whole] = pair
        self.width = [len(w) for w in words]
        self.automaton = ahocorasick.Automaton()
        for w, i in rank.items():
            self.automaton.add_word(w, i)
        self.automaton.make_automaton()
        self.shorter = [next((rank[w[:n]] for n in range(len(w) - 1, 0, -1) if w[:n] in rank), -1) for w in words]
        self.special = {x["content"]: x["id"] for x in said.get("added_tokens", [])}
        self.fits: dict[tuple[int, int], bool] = {}
        code = {c: b for b, c in enumerate(self.letters)}
        raw = {vocab[w]: bytes(map(code.__getitem__, w)) for w in words} | {i: w.encode() for w, i in self.special.items()}
        by_id = [raw.get(i, b"") for i in range(max(raw) + 1)]
        self.bytes_at = np.concatenate([[0], np.cumsum([len(b) for b in by_id])])
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self._words = regex.compile(WORDS)
        self._cut = None
        self._known: dict[str, bytes] = {}

    def _may_meet(self, left: int, right: int) -> bool:
        """Whether the ranked merges of both tokens' bytes keep the boundary between them: at no time
        may the parts that meet there have a merge that comes before the ones inside either token."""
        bound = 1 << 60
        while True:
            whole = self.merged.get((left, right))
            if whole is not None and whole < bound:
                return False
            if left > right:
                bound, (a, left) = left, self.halves[left]
                if a == left == bound:
                    bound, (right, b) = right + 1, self.halves[right]
                    if b == right:
                        return True
            else:
                bound, (right, b) = right + 1, self.halves[right]
                if b == right == bound - 1:
                    bound, (a, left) = left, self.halves[left]
                    if a == left:
                        return True

    def ranks(self, word: str) -> list[int]:
        """Tokens of a word given in byte letters."""
        n, out, pos, ends = len(word), [], 0, []
        longest = [0] * n
        for end, i in self.automaton.iter(word):
            longest[end - self.width[i] + 1] = i
        open_ = bytearray(b"\x01") * (n + 1)
        token, fits = longest[0], self.fits
        while True:
            end = pos + self.width[token]
            if open_[end]:
                if out:
                    pair = (out[-1], token)
                    good = fits.get(pair)
                    if good is None:
                        if len(fits) > 1_000_000:
                            fits.clear()
                        good = fits[pair] = self._may_meet(*pair)
                else:
                    good = True
                if good:
                    out.append(token)
                    ends.append(pos)
                    pos = end
                    if pos == n:
                        return out
                    token = longest[pos]
                    continue
            token = self.shorter[token]
            while token < 0:
                open_[pos] = 0
                token, pos = self.shorter[out.pop()], ends.pop()

    def _word(self, word: str) -> bytes:
        held = self._known.get(word)
        if held is None:
            if len(self._known) > 400_000:
                self._known.clear()
            held = self._known[word] = self.id_of[self.ranks("".join(map(self.letters.__getitem__, word.encode())))].tobytes()
        return held

    def words(self, piece: str) -> list[str]:
        """The words of a text. Beyond the older scripts, the tokenizers library's own cut decides, as
        Unicode versions differ in what is a letter."""
        if piece.isascii() or max(piece) < "ɐ":
            return self._words.findall(piece)
        if self._cut is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self._cut = ByteLevel(add_prefix_space=False)
        return [piece[a:b] for _, (a, b) in self._cut.pre_tokenize_str(piece)]

    def encode(self, pieces: list[str]) -> list[bytes]:
        return [b"".join(map(self._word, self.words(p))) for p in pieces]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, one after another."""
        start = self.bytes_at[ids]
        n = self.bytes_at[ids + 1] - start
        ends = np.cumsum(n)
        return self.bytes[np.repeat(start - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()


@lru_cache(maxsize=2)
def loaded(path: str) -> tuple[Bpe, PieceEncoder]:
    bpe = Bpe(path)
    return bpe, PieceEncoder(bpe.encode, bpe.special)


def _round_trip(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    @frugal
    def run(batches):
        bpe, pieces = loaded(path)
        shown = [str(i) for i in range(len(bpe.bytes_at))]
        for b in batches:
            for at, ids, cuts in pieces.blocks(b.column("text")):
                ids = ids.astype(np.int64)
                rows = [ids[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                decoded = (bpe.decode(r).decode("utf-8", "replace").encode() for r in rows)
                yield batch(
                    schema,
                    b.column("doc_id").slice(at, len(rows)),
                    np.diff(cuts),
                    [sha256(",".join([shown[i] for i in r.tolist()]).encode()).hexdigest() for r in rows],
                    [sha256(d).hexdigest() for d in decoded],
                )

    return run


def round_trip(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded, and its ids decoded again."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_round_trip(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: the ids themselves."""
    @frugal
    def run(batches):
        _, pieces = loaded(path)
        for b in batches:
            for at, ids, cuts in pieces.blocks(b.column("text")):
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(cuts) - 1), lists], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decoded(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """doc_id, text: the texts of rows of doc_id, ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    @frugal
    def run(batches):
        bpe, _ = loaded(path)
        for b in batches:
            lists = b.column("ids").to_pylist()
            yield batch(schema, b.column("doc_id"), [bpe.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in lists])

    return rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
