"""The filter audit, hard negatives and benchmark leaks against brute force, with nulls, ties, repeats and odd tables."""

import random
import re
from collections import Counter
from hashlib import sha256
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gravita.llm import audit, leaks, negatives
from gravita.llm import queries as llm

DOCS = "doc_id long, text string, lang string, source string, n_chars long, mask int, part string, n int, node long"


def docs_of(spark, rows):
    """rows: (doc_id, text, source); the other columns clash with the operators' own names."""
    return spark.createDataFrame([(i, t, "en", s, 1, 7, "x", 3, 0) for i, t, s in rows], DOCS).repartition(3)


# Filter audit


def texts(n=60, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{r.randrange(20 if i % 4 == 0 else 900)}" for _ in range(r.choice([3, 150, 199, 200, 201, 260]))]
        if i % 3 == 0:
            words = [w.upper() for w in words]
        if i % 5 == 0:
            words.append("#é日")
        out.append("\t".join(words))
    return out


def failing(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    upper = len(re.findall("[A-Z]", text))
    out = {"A"} if len(words) < 200 else set()
    out |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
    out |= {"C"} if 100 * upper > 2 * len(text) else set()
    return out | ({"D"} if re.search("[#$%&*|]", text) else set())


def audited(rows, labels):
    """What every order does, applied to every row one by one."""
    large = (1, 0)
    rank = lambda i: large if i is None else (0, i)
    least = {}
    for i, t, _ in rows:
        least[t or ""] = min(least.get(t or "", large), rank(i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    seen = [(i, s or "", failing(t or "") | ({"E"} if rank(i) > least[t or ""] else set())) for i, t, s in rows]
    count, shapley, parts = Counter(), Counter(), {s for _, s, _ in seen}
    for order in map("".join, permutations("ABCDE")):
        for i, part, fails in seen:
            gone = False
            for step, f in enumerate(order, 1):
                key = part, order, step
                if f in fails:
                    count[key, "unique"] += fails == {f}
                    count[key, "redundant" if gone else "removed"] += 1
                    if not gone:
                        count[key, "good"] += i in good
                        count[key, "toxic"] += i in toxic
                        shapley[part, f] += 1
                    gone = True
                count[key, "kept"] += not gone
    names = ("kept", "removed", "redundant", "unique", "good", "toxic")
    return {
        (p, o, s): (*(count[(p, o, s), n] for n in names), shapley[p, o[s - 1]]) for p in parts for o in map("".join, permutations("ABCDE")) for s in range(1, 6)
    }


def test_audit(spark):
    made = texts()
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(made)]
    rows += [(100 + i, made[7], "s1") for i in range(40)]  # a group of copies, the smallest id elsewhere
    rows += [(3, made[7], "s1"), (3, made[7], "s1"), (3, made[9], None), (None, made[9], ""), (None, "only without an id", "s0")]
    rows += [(None, "only without an id", "s0"), (300, None, "s2"), (301, "", "s2"), (302, None, None), (303, "word " * 50_000, "s0")]
    labels = [(i, i % 2, (i + 1) % 3 == 0) for i in range(0, 110, 2)] + [(4, 0, 1), (4, None, None), (None, 1, 1), (999, 1, 1)]
    named = spark.createDataFrame([(i, q, None if x is None else int(x)) for i, q, x in labels], "doc_id long, quality int, toxic int")
    found = audit.interactions(spark, docs_of(spark, rows), named).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:7] + (r.good_lost, r.toxic_lost, r.shapley) for r in found}
    assert len(found) == len(got) == 4 * 120 * 5
    assert got == audited(rows, [(i, q, None if x is None else int(x)) for i, q, x in labels])


def test_audit_settles_copies_in_small_blocks():
    """The same decisions whatever is settled where rows are read, and nothing but least ids travels with a text."""
    r = random.Random(5)
    rows = [(r.choice([None, *range(20)]), r.choice("ab"), r.choice(["x", "y" * 90, None, "z"])) for _ in range(300)]

    def decided(block):
        records = sorted((x for part in (rows[:100], rows[100:]) for x in audit.settled(part, block)), key=lambda x: x[0])
        out = Counter()
        for doc_id, part, mask, n in audit.chained(records):
            out[doc_id, part, mask] += n
        return out, sum(v[3] is not None for _, v in records)

    (small, many), (large, few) = decided(1), decided(1 << 30)
    assert small == large and sum(large.values()) == 300 and few <= 2 * 2 * 3 < many


def test_audit_tells_colliding_fingerprints_apart(monkeypatch):
    monkeypatch.setattr(audit.xxhash, "xxh64_intdigest", lambda text: 7)
    rows = [(2, "p", "one"), (1, "p", "two"), (3, "p", "one"), (4, "p", "two"), (5, "p", "three")]
    records = sorted((x for r in rows for x in audit.settled([r])), key=lambda x: x[0])
    assert {i: bool(m & audit.COPY) for i, _, m, _ in audit.chained(records)} == {1: False, 2: False, 3: True, 4: True, 5: False}


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(spark, docs_of(spark, []), none).count() == 0
    one = audit.interactions(spark, docs_of(spark, [(1, "a", "s")]), none).collect()
    assert len(one) == 600 and {r.shapley for r in one} == {0, 120}


# Hard negatives


def mined(rows, every=50, positives=5, k=3):
    """rows: (vec_id, label, vector)."""
    seen = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            own = tuple(int(np.floor(256 * float(c))) for c in v)
            seen[i, label, own] = True
    out = []
    for i, label, v in seen:
        if i % every:
            continue
        score = lambda o, v=v: sum(a * b for a, b in zip(v, o))
        near = sorted((-score(o), j) for j, lab, o in seen if j != i and lab == label)[:positives]
        far = sorted((-score(o), j, lab) for j, lab, o in seen if j != i and lab != label)
        for s, j in near:
            fits = [(j2, -t) for t, j2, _ in far if 50 * -s <= 100 * -t <= 95 * -s][:k]
            out += [(i, j, n, j2, -s, t) for n, (j2, t) in enumerate(fits, 1)]
    return sorted(set(out))


def vectors(n=600, dim=6, seed=2, spread=0.4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(8, dim))
    return [(i, int(r.integers(4)), [float(np.float32(x)) for x in centres[i % 8] + spread * r.normal(size=dim)]) for i in range(n)]


def table_of(spark, rows):
    given = [(i, lab, v, 1, 2, b"z") for i, lab, v in rows]
    return spark.createDataFrame(given, "vec_id long, label int, embedding array<float>, cell long, anchor long, v binary").repartition(3)


@pytest.mark.parametrize("sizes", [{}, {"cell": 40, "block": 32, "team": 2}])
def test_hard_negatives(spark, sizes):
    rows = vectors()
    rows += [(1000 + i, 1, rows[50][2]) for i in range(60)]  # copies of an anchor's vector: ties throughout
    rows += [(2000 + i, 2, rows[100][2]) for i in range(60)] + [rows[3]] * 3 + [(50, 3, rows[7][2]), (700, 9, rows[8][2])]
    rows += [(800, None, rows[0][2]), (None, 1, rows[0][2]), (850, 1, None), (900, 1, [None] * 6), (950, 1, [float("nan")] * 6), (951, 1, [float("inf")] * 6)]
    rows += [(1050, 0, [0.0] * 6), (1051, 0, [0.0] * 6), (1053, 1, [-0.0] * 6)]
    found = negatives.hard_negatives(spark, table_of(spark, rows), **sizes).collect()
    assert sorted(tuple(r) for r in found) == mined(rows)


def test_hard_negatives_spare_far_groups(spark):
    """Where cells lie apart, rows go to few groups, and nothing is lost."""
    rows = vectors(1200, 4, 5, 0.02)
    sent = []
    plain = negatives.Join.away

    def counted(self, bounds):
        found = plain(self, bounds)
        sent.append(found.count())
        return found

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(negatives.Join, "away", counted)
        found = negatives.hard_negatives(spark, table_of(spark, rows), every=10, cell=100).collect()
    assert sorted(tuple(r) for r in found) == mined(rows, 10)
    assert sent[0] < 12 * len(rows) / 2


def test_hard_negatives_of_large_components(spark):
    """Scores that doubles can't hold are exact, longer ones take no part."""
    r = np.random.default_rng(4)
    rows = [(i, i % 2, [float(np.float32(x)) for x in 3e5 * (1 + r.random(6))]) for i in range(40)]
    extra = [(50, 0, [1e30] * 6)]
    assert sorted(tuple(x) for x in negatives.hard_negatives(spark, table_of(spark, rows + extra), every=10).collect()) == mined(rows, 10)


def test_hard_negatives_of_odd_tables(spark):
    assert negatives.hard_negatives(spark, table_of(spark, [])).count() == 0
    assert negatives.hard_negatives(spark, table_of(spark, [(0, 1, []), (50, 1, [])])).count() == 0
    assert negatives.hard_negatives(spark, table_of(spark, [(1, 1, [1.0]), (2, 1, [1.0])])).count() == 0  # no anchor
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.6, 0.1]), (3, 2, [0.6, 0.1]), (4, 2, [1.0]), (5, 3, [0.96, 0.0])]
    assert sorted(tuple(r) for r in negatives.hard_negatives(spark, table_of(spark, rows)).collect()) == mined([r for r in rows if len(r[2]) == 2])


# Benchmark leaks

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def leaked(rows, items):
    windows = {}
    for item, t in items:
        w = WORDS.findall((t or "").translate(SMALL))
        for i in range(max(1, len(w) - 9)):
            if w:
                windows.setdefault(tuple(w[i : i + 10]), set()).add("" if item is None else str(item))
    out = []
    for i, t in rows:
        w = WORDS.findall((t or "").translate(SMALL))
        hit, named = set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if (own := tuple(w[at : at + n])) in windows:
                    hit.update(range(at, at + n))
                    named |= windows[own]
        out.append((i, len(w), len(hit), len(named), sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def leak_tables(seed=6):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["ÉCOLE", "日本", "x" * 40, "X" * 41, "a1"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 4, 9, 10, 11, 30, 60])))) for i in range(40)]
    items += [(3, "second part " + " ".join(r.choice(vocabulary) for _ in range(12))), (41, None), (42, ""), (43, "?!"), (None, "nameless item here"), (44, items[5][1]), items[6]]
    docs = []
    for i in range(120):
        t = " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 80)))
        if i % 3 == 0:
            own = (r.choice(items)[1] or "").split()
            cut = own[r.randint(0, 3) : r.randint(5, 60)]
            t += "... " + "; ".join(w.upper() if r.random() < 0.5 else w for w in cut) + "\n\x00" + t[:40]
        docs.append((i, t))
    docs += [(None, None), (None, items[5][1]), (7, "NAMELESS-item\there é"), (7, ""), (500, f"{'z ' * 100_000}{items[9][1]} {'y' * 100_000}")]
    return docs, items


@pytest.mark.parametrize("most", [leaks.MOST, 97])
def test_leaks(spark, most):
    docs, items = leak_tables()
    rows = docs_of(spark, [(i, t, "s") for i, t in docs])
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("x")).withColumn("window", F.lit(1))
    assert sorted((tuple(r) for r in leaks.contamination(spark, rows, table, most).collect()), key=str) == leaked(docs, items)


def test_leak_spans_are_places_in_the_original(spark):
    docs = [(1, "é🙂 intro. The QUICK,brown fox ÉTÉ -- jumps"), (2, "nothing"), (3, "the quick\nbrown FOX the quick brown fox")]
    items = spark.createDataFrame([(9, "the quick brown fox"), (8, "fox étÉ")], "item_id long, text string")  # É isn't lower-cased
    found = leaks.spans(spark, docs_of(spark, [(i, t, "s") for i, t in docs]), items).collect()
    text = dict(docs)
    assert sorted((r.doc_id, r["items"], text[r.doc_id][r.start : r.end]) for r in found) == [
        (1, ["9"], "The QUICK,brown fox"), (3, ["9"], "the quick\nbrown FOX the quick brown fox")
    ]


def test_leaks_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = docs_of(spark, [(1, "a b", "s"), (2, None, "s")])
    assert sorted(tuple(r)[:4] for r in leaks.contamination(spark, rows, none).collect()) == [(1, 2, 0, 0), (2, 0, 0, 0)]
    assert leaks.contamination(spark, docs_of(spark, []), none).count() == 0
    assert leaks.spans(spark, rows, none).count() == 0


def test_queries_are_registered():
    assert {"op11_filter_audit", "op12_hard_negatives", "op13_benchmark_leaks"} <= set(llm.QUERIES) & set(llm.SQL)
