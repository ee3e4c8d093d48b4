"""The text operators against brute force, on small tables with nulls, ties, copies and odd texts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gravita.llm import bpe, exact, language, nearjoin, neighbours, packing, quality, substrings, tokenio, toxicity
from gravita.llm.common import Scratch
from gravita.llm.components import components
from gravita.llm.queries import vocabulary
from gravita.llm.tokens import library_encoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "a", "\n\n\n a \n b", "x  y   z", "<|endoftext|> a", "日本語 　 text", "word " * 5000, "a" * 20000, "it's\tok\r\n", "🙂é́ ß", "\x00\x1c b"]


def corpus(n=120, seed=1):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefg") for _ in range(r.randint(2, 7))) for _ in range(400)]
    make = lambda k: " ".join(r.choice(words) for _ in range(k))
    passage, out = make(70), []
    for i in range(n):
        t = make(r.randint(1, 150))
        if i % 7 == 0:
            t = f"{t} {passage} {make(20)}"
        if i % 5 == 0 and out:
            w = r.choice(out).split(" ")
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(words)
            t = " ".join(w)
        out.append(t)
    return out + out[:10] + [passage + " " + passage]


def documents(spark, texts):
    rows = [(i, t, ("en", "fr")[i % 2], "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def texts():
    return [*corpus(), *ODD, *ODD[:4]]


def test_exact(spark, texts):
    rows = exact.exact_duplicates(spark, documents(spark, texts), counters=8, heavy_share=0.2).collect()
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(t or "", []).append(i)
    assert len(rows) == len(texts)
    for r in rows:
        own = groups[texts[r.doc_id] or ""]
        assert (r.keep_id, r.group_size, r.kept) == (max(own), len(own), r.doc_id == max(own))
        assert r.text_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert exact.drop_exact_duplicates(spark, documents(spark, texts)).count() == len(groups)


def test_filter_of_groups_misses_none(spark, monkeypatch):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    groups = keys.filter("length(key) = 3")
    for bits in (exact.BITS, 6):  # enough, and hopelessly few
        monkeypatch.setattr(exact, "BITS", bits)
        asked = exact.may_hold(keys, groups, "key")
        assert asked.columns == ["key", "maybe"] and asked.count() == 3000
        found = {r.key for r in asked.filter("maybe").collect()}
        assert found >= {f"k{i}" for i in range(10, 100)} and (len(found) < 500 or bits == 6)


def test_misra_gries_keeps_heavy_items():
    r, held = random.Random(2), {}
    items = ["hot"] * 400 + [str(r.randrange(300)) for _ in range(800)]
    r.shuffle(items)
    for i in range(0, len(items), 50):
        held = exact.misra_gries(items[i : i + 50], held, 9)
    assert len(held) <= 9 and 400 - len(items) / 10 <= held["hot"] <= 400


def test_heavy_digests_are_bounded_and_complete(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(b"x")).otherwise(F.col("id").cast("string").cast("binary")).alias("digest"))
    assert [r.digest for r in exact.heavy_digests(rows, 64, 0.1).collect()] == [b"x"]


def shingle_sets(texts):
    low = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    words = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(low)) for t in texts]
    return [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set()) for w in words]


def near_classes(texts):
    sets = shingle_sets(texts)
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return sets, [root(i) for i in range(len(sets))]


def crowd(n=60, seed=4):
    """Copies of one text with some words changed: many pairs are near, many are not quite."""
    r = random.Random(seed)
    base = [f"w{r.randrange(900)}" for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"v{r.randrange(900)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("kind", ["mixed", "crowd"])
def test_near_duplicates(spark, texts, kind):
    own = texts if kind == "mixed" else crowd()
    sets, roots = near_classes(own)
    rows = nearjoin.near_duplicates(spark, documents(spark, own)).collect()
    assert len(rows) == len(own)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (len(s), k) for i, (s, k) in enumerate(zip(sets, roots))}
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (300, 300)]
    found = components(Scratch(spark, "test"), spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.component for r in found} == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}


def removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = len(re.findall(b"\x01+", bytes(gone)))
        out.append((len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("most, hot", [(substrings.CROWD, 2048), (3, 2048), (3, 8), (3, 0)])
def test_repeats(spark, monkeypatch, most, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    own = [*corpus(60), None, "", "ab" * 300, "x" * 150, "é" * 400]
    want = removed(own, 100)
    rows = substrings.removed_repeats(spark, documents(spark, own), length=100, gram=20, crowd=most).collect()
    assert len(rows) == len(own)
    for r in rows:
        n, gone, runs, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, runs, hashlib.sha256(kept).hexdigest())


def test_drop_repeats_keeps_columns(spark):
    own = [*corpus(40), None, "ab" * 300]
    want = removed(own, 100)
    docs = documents(spark, own).withColumn("key", F.lit(7)).withColumn("mark", F.lit("m"))
    rows = substrings.drop_repeats(spark, docs, length=100, gram=20).collect()
    assert {r.doc_id: r.text for r in rows} == {i: None if t is None else w[3].decode("utf-8", "ignore") for i, (t, w) in enumerate(zip(own, want))}
    assert all(r.key == 7 and r.mark == "m" and (r.text is None or r.n_chars == len(r.text)) for r in rows)


def library(texts):
    t = Tokenizer.from_file(vocabulary())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts], t


def test_encoders_equal_the_library(texts):
    r = random.Random(9)
    alphabet = ["a", "b", " ", "\n", "\t", "'s", "é", "日", "　", "\xa0", "1", "!", "<|endoftext|>", "🙂", "ab", "the"]
    own = [*texts, *("".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(1500))]
    want, _ = library(own)
    for encoder in (bpe.loaded(vocabulary())[1], library_encoder(vocabulary())):
        for first, ids, cuts in encoder.blocks(pa.array(own)):
            for i in range(len(cuts) - 1):
                assert ids[cuts[i] : cuts[i + 1]].tolist() == want[first + i], own[first + i]


def test_bpe_round_trip(spark, texts):
    want, t = library(texts)
    for r in bpe.round_trip(spark, documents(spark, texts), vocabulary()).collect():
        ids = want[r.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decoded(spark, bpe.encoded(spark, documents(spark, texts), vocabulary()), vocabulary())
    assert {r.doc_id: r.text for r in back.collect()} == {i: x or "" for i, x in enumerate(texts)}
    assert bpe.loaded(vocabulary())[0].decode(np.array([0xFF % 256])) is not None


def test_token_files(spark, texts, tmp_path):
    want, _ = library(texts)
    folder = f"file://{tmp_path}/ids"
    tokenio.write_tokens(documents(spark, texts), folder, vocabulary())
    at, starts = 0, {}
    for i, ids in enumerate(want):
        starts[i] = (at, len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4")))
        at += len(ids) + 1
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokenio.token_digests(spark, folder).collect()} == starts
    assert {r.doc_id: r.ids for r in tokenio.read_tokens(spark, folder).collect()} == {i: [*ids, 0] for i, ids in enumerate(want)}
    files = sorted((tmp_path / "ids").glob("part-*.parquet"))
    firsts = [pq.read_table(f, columns=["doc_id"]).column(0).to_pylist() for f in files]
    assert [i for part in firsts for i in part] == list(range(len(texts)))
    group = pq.ParquetFile(files[0]).metadata.row_group(0)
    held = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "RLE_DICTIONARY" in held["ids.list.element"].encodings and "DELTA_BINARY_PACKED" in held["doc_id"].encodings
    assert held["doc_id"].has_offset_index and held["doc_id"].has_column_index


def test_packing(spark, texts):
    want, _ = library(texts)
    rows = packing.pack(spark, documents(spark, texts), vocabulary(), window=128, shard_docs=30).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, pieces in by_doc.items():
        ids, at = np.array([*want[i], 1], "<u4"), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length])
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 128 and at & (at - 1) == 0


def test_packing_joins_related_documents():
    docs = [np.array([1, 2, 3, 9]), np.array([4, 5, 6, 9]), np.array([1, 2, 3, 8])]
    stats = packing.Bm25(dict.fromkeys(range(10), 1) | {-1: 100, -2: 400})
    filler = packing.Filler(8, 0)
    packing.fill_shard(filler, [0, 1, 2], docs, stats)
    assert [p[0] for p in filler.take(last=True)] == [0, 2, 1]


def test_language(spark):
    r = random.Random(3)
    parts = {"en": ["the", "and", "ing", "tion", "er"], "fr": ["eau", "eux", "le", "ou", "ment"], "de": ["ung", "sch", "der", "keit", "ein"]}
    rows = []
    for i in range(300):
        lang = ("en", "fr", "de")[i % 3]
        rows.append((i, " ".join(r.choice(parts[lang]) for _ in range(30)), lang, "s", 1))
    odd = [(300, None, "en", "s", 0), (301, "123 !?", "en", "s", 0), (302, "the and", None, "s", 0), (None, "eau eux le", "fr", "s", 0)]
    docs = spark.createDataFrame(rows + odd, DOCS)
    got = {r.doc_id: r for r in language.identify(spark, docs).collect()}
    assert len(got) == 304 and got[300].lang_pred == got[301].lang_pred == "und" and got[302].lang_pred == "en"
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i in held) and np.mean([got[i].lang_pred == rows[i][2] for i in held]) > 0.95
    assert {r.doc_id for r in docs.join(language.keep_identified(spark, docs).select("doc_id"), "doc_id", "left_anti").filter("doc_id IS NOT NULL").collect()} <= {300, 301, 302}
    assert language.identify(spark, docs.filter("lang IS NULL")).first().lang_pred == "und"


def test_codewords_are_apart():
    for k in (2, 3, 5, 9):
        code = language.codewords(k)
        apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert min(apart) >= max(1, code.shape[1] // 4)


def labelled(spark, marks):
    r = random.Random(8)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(400):
        w = [r.choice(words) for _ in range(r.randint(5, 60))]
        bad = r.random() < 0.3
        if bad:
            for _ in range(2):
                w.insert(r.randrange(len(w)), r.choice(marks))
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, int(not bad), int(bad)))
    rows += [(400, None, "en", "s", None), (401, "", "en", "s", 0)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((a, (b, c)) for a, b, c in labels)


def test_toxicity(spark):
    docs, labels, truth = labelled(spark, ["zzvile", "zzvilest", "qqnasty"])
    got = {r.doc_id: r for r in toxicity.score(spark, docs, labels).collect()}
    held = [i for i in range(400) if got[i].held_out]
    assert len(got) == 402 and len(held) > 50 and np.mean([got[i].predicted == truth[i][1] for i in held]) > 0.97
    assert got[400].predicted == got[401].predicted == 0
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(any(m in text[i][s.begin : s.end] for m in ("zzvil", "qqnasty")) for i in held for s in got[i].spans)
    assert toxicity.score(spark, docs, labels.limit(0)).filter("score <> 0").count() == 0


def test_chain_marginals_equal_enumeration():
    r = np.random.default_rng(1)
    score, lengths, moves = r.normal(size=9), np.array([4, 0, 5]), r.normal(size=(2, 2))
    got, at = toxicity.marginals(score, lengths, moves), 0
    for n in lengths:
        p, total = np.zeros(n), 0.0
        for states in range(1 << n):
            y = [(states >> k) & 1 for k in range(n)]
            w = np.exp(sum(score[at + k] * y[k] for k in range(n)) + sum(moves[y[k], y[k + 1]] for k in range(n - 1)))
            total += w
            p += w * np.array(y) if n else 0
        assert np.allclose(got[at : at + n], p / total)
        at += n


def test_quality(spark):
    docs, labels, truth = labelled(spark, ["BUY!!!", "$$$", "|||"])
    got = {r.doc_id: r for r in quality.score(spark, docs, labels).collect()}
    held = [i for i in range(400) if got[i].held_out]
    assert len(got) == 402 and np.mean([got[i].predicted == truth[i][0] for i in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in got.values())


def test_machine_pairs_equal_the_double_sum():
    m = quality.Machine()
    m.v = np.random.default_rng(2).normal(size=m.v.shape)
    col, x = np.array([3, 10, 77]), np.array([0.5, 1.0, 2.0])
    want = sum(m.v[col[i]] @ m.v[col[j]] * x[i] * x[j] for i in range(3) for j in range(i))
    assert np.isclose(m.margin(np.zeros(3, int), col, x, 1)[0][0], want)


def test_neighbours(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(900, 16)) * r.uniform(0.5, 2, size=(900, 1))
    x[100:160] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(901, None), (920, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0]), (904, [None] * 16), (5, x[5].tolist())]
    got = {}
    for q in neighbours.nearest(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=128).collect():
        got.setdefault(q.query_id, []).append((q.rank, q.vec_id, q.score))
    assert set(got) == set(range(0, 900, 20))
    hits = 0
    for i, found in got.items():
        s = (x * x[i]).sum(1)
        s[i] = -np.inf
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and np.allclose([f[2] for f in found], s[[f[1] for f in found]], rtol=1e-12)
        hits += len({f[1] for f in found} & set(np.lexsort((np.arange(900), -s))[:20]))
    assert hits / (20 * len(got)) >= 0.9


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (
        exact.exact_duplicates(spark, docs), nearjoin.near_duplicates(spark, docs), substrings.removed_repeats(spark, docs), bpe.round_trip(spark, docs, vocabulary()),
        tokenio.round_trip(spark, docs, vocabulary()), packing.pack(spark, docs, vocabulary()), language.identify(spark, docs), toxicity.score(spark, docs, labels),
        quality.score(spark, docs, labels), neighbours.nearest(spark, spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ):
        assert out.count() == 0


def test_packing_finds_neighbours_in_other_shards(spark):
    r = random.Random(12)
    words = ["".join(r.choice("bcdfghklmn") for _ in range(6)) for _ in range(4000)]
    first = [" ".join(r.sample(words, 12)) for _ in range(40)]
    pairs = first + [" ".join(r.sample(t.split(), 12)) for t in first]  # the copy of each is 40 rows away
    want, _ = library(pairs)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(pairs)], DOCS).coalesce(1)
    rows = packing.pack(spark, docs, vocabulary(), window=2 * max(map(len, want)), shard_docs=10).collect()
    assert sum(r.length for r in rows) == sum(len(w) + 1 for w in want)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, set()).add(r.doc_id % 40)
        held.setdefault(("both", r.sequence_id), set()).add(r.doc_id)
    together = {i for s, d in held.items() if isinstance(s, tuple) for i in range(40) if {i, i + 40} <= d}
    assert len(together) >= 20


def test_toxicity_undoes_the_sampling():
    toxic = np.array([True] * 10 + [False] * 20)
    w = toxicity.stands_for(toxic, (800, 100))
    assert np.isclose(w.mean(), 1) and np.isclose(w[~toxic].sum() / w[toxic].sum(), 8)
    seen = np.array([[40.0, 5.0], [40.0, 1e-9]])  # 40 of 50 toxic, once the others count eight times
    assert toxicity.telling(seen, 100, 100, 8.0).tolist() == [False, True] and toxicity.telling(seen, 100, 100).all()
    r = random.Random(5)
    own = [" ".join(r.choice(["ab", "cd", "ef", "gh"]) for _ in range(30)) + (" zzvile" if y and i % 2 else "") for i, y in enumerate(toxic.tolist() * 8)]
    mean = [toxicity.train(own, np.tile(toxic, 8), t).scores(np.array([[1.0, -10.0, 0.0]]))[0] for t in ((160, 80), (16000, 80))]
    assert mean[1] < mean[0]


def test_toxicity_copies_share_most_pairs_with_one_document():
    r = np.random.default_rng(4)
    docs = [np.concatenate([np.arange(12), r.integers(20, 5000, 80)]) for _ in range(60)]  # few pairs in common, no copies
    near = docs[0].copy()
    near[40] = 15
    assert toxicity.originals([*docs, near, docs[5].copy()]).tolist() == [True] * 60 + [False, False]


def test_quality_undoes_the_sampling(spark):
    docs = spark.createDataFrame([(i, "one text for all", "en", "s", 16) for i in range(400)], DOCS)
    labels = spark.createDataFrame([(i, int(i % 10 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    parts = quality.inputs(["one text for all"], [16], quality.Words())
    whole, sampled = (quality.fit(docs, labels, most).scores(parts, 1)[0] for most in (400, 20))
    assert abs(whole - 0.9) < 0.05 and abs(sampled - whole) < 0.05


REPEATED = [(3, "a b c d e f g"), (3, "a b c d e f g"), (3, "other words of the same document"), (None, "a b c d e f g"), (None, None), (1, ""), (2, "a b c d e f g h")]


def repeated(spark, more=()):
    """Rows whose ids repeat or are null, with columns whose names clash with those that operators use."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in [*REPEATED, *more]]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for name in ("key", "mark", "node", "row", "u", "v", "n", "digest", "component", "bucket", "_row", "task", "score", "anchor"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def test_near_duplicates_of_repeated_ids(spark):
    rows = nearjoin.near_duplicates(spark, repeated(spark)).collect()
    assert len(rows) == len(REPEATED)
    of = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows)
    assert of == Counter({(3, 3, 2, False): 2, (None, 3, 2, False): 1, (2, 4, 2, True): 1, (3, 2, 3, True): 1, (None, 0, None, True): 1, (1, 0, 1, True): 1})


def test_repeats_of_repeated_ids(spark):
    more = [(9, "xy" * 200), (9, "xy" * 200), (None, "z" * 50)]
    want = removed([t for _, t in [*REPEATED, *more]], 100)
    rows = substrings.removed_repeats(spark, repeated(spark, more), length=100, gram=20).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in rows)
    assert got == Counter((i, n, gone, hashlib.sha256(kept).hexdigest()) for (i, _), (n, gone, _, kept) in zip([*REPEATED, *more], want))


def test_token_files_of_repeated_ids(spark):
    rows = [tokenio.round_trip(spark, repeated(spark).repartition(n), vocabulary()).collect() for n in (1, 5)]
    assert sorted(rows[0], key=lambda r: r.start) == sorted(rows[1], key=lambda r: r.start)
    ids, _ = library([t for _, t in REPEATED])
    assert Counter((r.doc_id, r.n_tokens) for r in rows[0]) == Counter((i, len(x) + 1) for (i, _), x in zip(REPEATED, ids))
    at = 0
    for r in sorted(rows[0], key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(rows[0], key=lambda r: r.start)] == [None, None, 1, 2, 3, 3, 3]


def test_packing_of_repeated_ids(spark):
    rows = packing.pack(spark, repeated(spark), vocabulary(), window=8).collect()
    ids, _ = library([t for _, t in REPEATED])
    assert sum(r.length for r in rows) == sum(len(x) + 1 for x in ids)
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(i for i, _ in REPEATED)


def test_other_operators_take_repeated_ids(spark):
    docs = repeated(spark, [(8, "word " * 30000)])
    labels = spark.createDataFrame([(3, 1, 1), (3, 0, 0), (2, 1, 0), (2, None, None), (None, 1, 1), (8, 0, 1)], "doc_id long, quality int, toxic int")
    want = Counter([*(i for i, _ in REPEATED), 8])
    for out in (toxicity.score(spark, docs, labels), quality.score(spark, docs, labels), quality.score(spark, docs.drop("n_chars"), labels), language.identify(spark, docs), bpe.round_trip(spark, docs, vocabulary())):
        assert Counter(r.doc_id for r in out.collect()) == want
    assert Counter(r.doc_id for r in exact.drop_exact_duplicates(spark, docs).collect()) == Counter([3, 3, None, 1, 2, 8]) - Counter([None])


def test_suffixes_are_told_apart_by_bytes():
    r = np.random.default_rng(6)
    for length in (1, 3, 8, 13, 200):
        raw = np.concatenate([r.integers(97, 99, 900), np.tile(r.integers(97, 123, 230), 2)]).astype(np.uint8)
        start = r.permutation(len(raw) - length + 1)
        seen = Counter(raw[s : s + length].tobytes() for s in start)
        found = substrings.equal_suffixes(raw, start, np.zeros(len(start), np.int64), length)  # all under one first digit
        assert sorted(found.tolist()) == [i for i, s in enumerate(start) if seen[raw[s : s + length].tobytes()] > 1]
        ordered = [raw[start[i] : start[i] + length].tobytes() for i in found]
        assert ordered == sorted(ordered)


def test_repeats_whatever_the_fingerprints(spark, monkeypatch):
    """With anchors that all collide, bytes alone decide."""
    monkeypatch.setattr(substrings.Fingerprints, "all", lambda self, a, n: np.zeros(len(a) - n + 1, np.uint64))
    own = corpus(12)
    want = removed(own, 100)
    raw = [np.frombuffer(t.encode(), np.uint8) for t in own]
    rows = [(0, i, 0, f, la - f + 1, p - f, a[f : la + 100].tobytes()) for i, a in enumerate(raw) for h, f, la, p in zip(*(x.tolist() for x in substrings.anchors(a, 100, 20)))]
    columns = list(zip(*rows))
    spans = substrings._repeated(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, substrings._CONTEXT)], schema=substrings._CONTEXT), 100).to_pylist()
    for i, (_, gone, runs, _) in enumerate(want):
        merged = substrings.merged([s for s in spans if s["key"] == i])
        assert (sum(e - b for b, e in merged), len(merged)) == (gone, runs)


def test_buckets_hold_all_pairs_within_the_distance():
    r = np.random.default_rng(2)
    for _ in range(300):
        a = r.integers(0, 1 << nearjoin.BITS, nearjoin.SYMBOLS).astype("<u4")
        b = a.copy()
        b[r.choice(nearjoin.SYMBOLS, nearjoin.DISTANCE, replace=False)] ^= 1
        x, y = nearjoin.buckets(np.stack([a, b]))
        assert set(x.tolist()) & set(y.tolist()) and len(set(x.tolist())) == nearjoin.SYMBOLS


@pytest.mark.parametrize("block", [1, 1 << 19])
def test_near_duplicates_in_small_blocks(spark, monkeypatch, block):
    """A chain of texts, each near the next only, among texts that share a part but reach nothing."""
    monkeypatch.setattr(nearjoin, "BLOCK", block)
    monkeypatch.setattr(nearjoin, "VISITORS", 2)
    r = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    chain, w = [], [r.choice(words) for _ in range(90)]
    for _ in range(12):
        chain.append(" ".join(w))
        w = w[3:] + [r.choice(words) for _ in range(3)]
    half = " ".join(r.choice(words) for _ in range(60))
    own = [*chain, *(f"{half} {' '.join(r.choice(words) for _ in range(20 + i % 9))}" for i in range(30)), *crowd(20, 9)]
    sets, roots = near_classes(own)
    rows = nearjoin.near_duplicates(spark, documents(spark, own)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in rows} == {i: (len(s), k) for i, (s, k) in enumerate(zip(sets, roots))}


def test_shelves_take_every_document_and_split_hot_ones():
    r = np.random.default_rng(3)
    sample = np.concatenate([r.normal(size=(600, packing.DIMS)), np.zeros((300, packing.DIMS))]).astype(np.float32)
    shelves = packing.Shelves(sample, 12)
    shelf, _ = shelves.place(sample)
    assert (shelf >= 0).all() and len(np.unique(shelf[:600])) > 12
    assert shelves.shared[shelf[-1]] >= 3 and (shelves.first + shelves.shared <= 12).all()
    assert packing.Shelves(sample[:0], 1).place(sample[:2])[0].tolist() == [0, 0]


def test_exact_keeps_one_row_of_a_group(spark):
    for share in (0.01, 1.0):  # decided where they are read, or shuffled
        rows = exact.exact_duplicates(spark, repeated(spark), counters=64, heavy_share=share).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size) for r in rows) == Counter({(3, 3, 3): 2, (None, 3, 3): 1, (3, 3, 1): 1, (None, 1, 2): 1, (1, 1, 2): 1, (2, 2, 1): 1})
        assert Counter(r.text_sha256 for r in rows if r.kept) == Counter({r.text_sha256: 1 for r in rows})
        assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_token_files_are_read_in_part(spark, texts, tmp_path):
    folder = str(tmp_path / "ids")
    tokenio.write_tokens(documents(spark, texts), folder, vocabulary())
    ids, _ = library(texts)
    rows = tokenio.read_tokens(spark, folder)
    seventh = rows.filter("doc_id = 7")
    plan = seventh._jdf.queryExecution().toString()
    assert seventh.first().ids == [*ids[7], 0] and "EqualTo(doc_id,7)" in plan
    small = rows.select("doc_id", "start", "n_tokens")
    assert "ids" not in small._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]
    at = 0
    for r, own in zip(small.orderBy("doc_id").collect(), ids):
        assert (r.start, r.n_tokens) == (at, len(own) + 1)
        at += r.n_tokens
    for f in (tmp_path / "ids").glob("part-*.parquet"):
        meta = pq.ParquetFile(f).metadata
        assert all(meta.row_group(i).total_byte_size <= 33 << 20 for i in range(meta.num_row_groups))
