"""Whole texts to token ids, for byte-level BPE vocabularies whose words never span a change from a
visible character to white space.

A batch is cut at spaces and line ends into pieces. Each distinct piece is encoded once and its ids are
gathered for all its occurrences, so the cost follows the distinct pieces, not the text. Texts where a
cut could fall inside a run of white space, or that hold a special token, are cut more carefully one by
one. The ids equal those of the whole text encoded at once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The characters with Unicode's White_Space property.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Marks that close a word and never join with it.
MARKS = ".,;:!?"
_RUNS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Pieces a worker remembers at most once a block is done, bytes of text handled at once, and pieces encoded in one call.
REMEMBERED = 300_000
BLOCK = 4 << 20
JOINED = 500


class Pieces:
    """Pieces met so far with their ids, as Arrow and NumPy columns. A piece's number is its place among
    them; size -1 marks a piece that can't be cut off the text around it."""

    def __init__(self):
        self.words = pa.array([], pa.string())
        self.ids, self.start, self.size, self.seen = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.now = 0

    def number(self, values: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The number of each value, and the values that are new, in the order of the numbers they get."""
        self.now += 1
        coded = pa.chunked_array([self.words, values], pa.string()).dictionary_encode().combine_chunks()
        coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
        known = len(self.words)
        return coded.indices.to_numpy(zero_copy_only=False)[known:], coded.dictionary.slice(known)

    def learn(self, words: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        n = np.maximum(size, 0)
        self.words = pa.concat_arrays([self.words, words])
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(n, dtype=np.int64) - n])
        self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size.astype(np.int32)])
        self.seen = np.concatenate([self.seen, np.full(len(size), self.now, np.int32)])

    def forget(self, used: np.ndarray, most: int) -> None:
        """Keep the half met last once there are more than ``most``."""
        self.seen[used] = self.now
        if len(self.words) > most:
            keep = np.sort(np.argsort(-self.seen, kind="stable")[: most // 2])
            n = np.maximum(self.size[keep], 0)
            self.words, self.ids, self.start = self.words.take(pa.array(keep)), _gathered(self.ids, self.start[keep], n), np.cumsum(n, dtype=np.int64) - n
            self.size, self.seen = self.size[keep], self.seen[keep]


def _gathered(held: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``held`` one after another."""
    ends = np.cumsum(size, dtype=np.int32)
    at = np.repeat(start.astype(np.int32) - (ends - size.astype(np.int32)), size)
    at += np.arange(len(at), dtype=np.int32)
    return held[at]


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _flat(ids: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter((-1 if x is None else len(x) // 4 for x in ids), np.int32, len(ids))
    return np.frombuffer(b"".join(x for x in ids if x), "<u4"), size


class PieceEncoder:
    """encode(pieces) gives the ids of each piece as little-endian unsigned 32-bit bytes; encode_words, for
    letters alone, with or without one space in front, all ids and how many each has."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], special: dict[str, int], encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]] | None = None):
        self._encode_words = encode_words or (lambda words: _flat(encode(words)))
        self._encode, self._special = encode, {k: np.uint32(v).tobytes() for k, v in special.items()}
        self._split = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self._pieces, self._words, self._alone = Pieces(), Pieces(), {}

    def _raw(self, pieces: list[str]) -> None:
        """Learn pieces that stand as they are."""
        new = [p for p in dict.fromkeys(pieces) if p not in self._alone]
        self._alone.update(zip(new, self._encode(new), strict=True))

    def one(self, text: str) -> bytes:
        out = []
        for part in self._split.split(text) if self._split else [text]:
            if part in self._special:
                out.append(self._special[part])
            elif part:
                runs = _RUNS.findall(part)
                self._raw(runs)
                out += map(self._alone.__getitem__, runs)
        return b"".join(out)

    def _hard(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of any pieces that follow a space. Sound ones have no white space at their ends, but
        for one line end in front, and hold no special token."""
        pieces = _strings(words)
        sound = [p for p in pieces if p and not p[-1].isspace() and (not p[0].isspace() or (p[0] == "\n" and not p[1].isspace()))]
        for token in self._special:
            sound = [p for p in sound if token not in p]
        ids = self._encode([p if p[0] == "\n" else " " + p for p in sound])
        if len(sound) < len(pieces):
            known = dict(zip(sound, ids, strict=True))
            ids = [known.get(p) for p in pieces]
        return _flat(ids)

    def _learn(self, pieces: pa.Array) -> None:
        """Learn pieces that follow a space. Letters before closing marks stand for themselves, as do the
        marks and a line end in front, so that such pieces are put together from words met before."""
        line = pc.starts_with(pieces, "\n")
        core = pc.if_else(line, pc.utf8_slice_codeunits(pieces, 1), pieces)
        word = pc.utf8_rtrim(core, characters=MARKS)
        plain = pc.utf8_is_alpha(word).to_numpy(zero_copy_only=False)
        rest, size = self._hard(pieces.filter(pa.array(~plain)))
        every = np.empty(len(pieces), np.int32)
        every[~plain] = size
        if plain.any():
            core, word, line = (x.filter(pa.array(plain)) for x in (core, word, line))
            which, new = self._words.number(pc.binary_join_element_wise(pc.if_else(line, "", " "), word, ""))
            if len(new):
                self._words.learn(new, *self._encode_words(_strings(new)))
            marked = (pc.binary_length(core).to_numpy() > pc.binary_length(word).to_numpy()).nonzero()[0]
            ends = [c[len(w) :] for c, w in zip(_strings(core.take(pa.array(marked))), _strings(word.take(pa.array(marked))), strict=True)]
            self._raw(["\n", *ends])
            kinds = {e: i + 1 for i, e in enumerate(dict.fromkeys(["\n", *ends]))}
            more, held = _flat([b"", *(self._alone[e] for e in kinds)])
            first, base = np.cumsum(held) - held + len(self._words.ids), np.concatenate([self._words.ids, more])
            part = np.zeros((len(word), 3), np.int64)
            part[:, 0] = line.to_numpy(zero_copy_only=False)
            part[marked, 2] = [kinds[e] for e in ends]
            start, size = first[part], held[part]
            start[:, 1], size[:, 1] = self._words.start[which], self._words.size[which]
            every[plain] = size.sum(1)
            ids = _gathered(base, start.ravel(), size.ravel())
            self._words.forget(which, REMEMBERED)
            n, at = np.maximum(every, 0), np.empty(len(every), np.int64)
            for mine, shift in ((plain, 0), (~plain, len(ids))):
                at[mine] = shift + np.cumsum(n[mine]) - n[mine]
            rest = _gathered(np.concatenate([ids, rest]), at, n)
        self._pieces.learn(pieces, rest, every)

    def block(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column (null: empty), and where each text's ids begin and the last end."""
        column = pc.fill_null(column, "")
        pieces = pc.split_pattern(pc.replace_substring(column, pattern="\n", replacement=" \n"), pattern=" ")
        values, cuts = pieces.flatten(), pieces.offsets.to_numpy().astype(np.int64)
        cuts -= cuts[0]
        first = cuts[:-1]
        heads = _strings(values.take(pa.array(first)))
        table = self._pieces
        which, new = table.number(values)
        del pieces, values
        if len(new):
            self._learn(new)
        size = table.size[which]
        rough = np.minimum.reduceat(size, first) < 0
        if len(self._alone) > REMEMBERED // 8:
            self._alone.clear()
        self._raw([h for h, r in zip(heads, rough, strict=True) if not r])
        for i in np.flatnonzero(rough):
            size[cuts[i] : cuts[i + 1]] = 0
        # A text's own entry (its first piece, or the whole of it) comes before the known pieces of the rest.
        own = [self.one(column[i].as_py()) if rough[i] else self._alone[h] for i, h in enumerate(heads)]
        n = np.fromiter(map(len, own), np.int64, len(own)) // 4
        held, at = np.concatenate([table.ids, np.frombuffer(b"".join(own), "<u4")]), table.start[which]
        at[first], size[first] = len(table.ids) + np.cumsum(n) - n, n
        ids = _gathered(held, at, size)
        table.forget(which, REMEMBERED)
        pa.default_memory_pool().release_unused()
        return ids, np.concatenate([[0], np.cumsum(size, dtype=np.int64)])[cuts]

    def blocks(self, column: pa.Array):
        """(first row, ids, offsets) of parts of the column, each of about BLOCK bytes of text or one row."""
        size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(column):
            n = max(1, int(np.searchsorted(np.cumsum(size[at:]), BLOCK)))
            yield at, *self.block(column.slice(at, n))
            at += n


@lru_cache(maxsize=2)
def library_encoder(path: str) -> PieceEncoder:
    """Pieces encoded by the tokenizers library. Pieces that begin with white space and end without it
    are encoded joined, and told apart by the bytes of their tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    vocab = t.get_vocab()
    special = {x.content: i for i, x in t.get_added_tokens_decoder().items()}
    width = np.zeros(max(vocab.values()) + 1, np.int64)
    for word, i in vocab.items():
        width[i] = len(word)
    joins = re.compile(f"[{WHITE}]")

    def joined(pieces: list[str]) -> list[bytes]:
        ids = np.array(t.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum([len(p.encode()) for p in pieces])
        at = (4 * (np.searchsorted(np.cumsum(width[ids]), ends) + 1)).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *at[:-1]], at, strict=True)]

    def encode(pieces: list[str]) -> list[bytes]:
        out: dict[str, bytes] = {}
        easy = [p for p in pieces if joins.match(p) and not p[-1].isspace()]
        for i in range(0, len(easy), JOINED):
            out |= zip(easy[i : i + JOINED], joined(easy[i : i + JOINED]), strict=True)
        if len(out) < len(pieces):
            hard = [p for p in pieces if p not in out]
            out |= zip(hard, (np.array(e.ids, "<u4").tobytes() for e in t.encode_batch_fast(hard, add_special_tokens=False)), strict=True)
        return [out[p] for p in pieces]

    letters = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    spare = iter(range(256, 512))
    as_byte_level = {b: letters.get(b) or chr(next(spare)) for b in range(256)}
    model = t.model

    def encode_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters are one pre-token each: the model takes them in its byte-level alphabet."""
        spelled = "\n".join(words).encode().decode("latin-1").translate({b: c for b, c in as_byte_level.items() if b != 10}).split("\n")
        found = list(map(model.tokenize, spelled))
        return np.fromiter((x.id for tokens in found for x in tokens), "<u4"), np.fromiter(map(len, found), np.int32, len(found))

    return PieceEncoder(encode, special, encode_words)
