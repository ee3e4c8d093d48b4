"""Stages of the pipeline on repeated rows, null ids and ids that stand on several rows."""

import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import DOCS, library


def passage(seed, n=120):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


def changed(text):
    return text.rsplit(" ", 1)[0] + " other"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS).repartition(3)


def after(spark, rows, *stages):
    docs = table(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        if name in stages:
            docs = stage(spark, docs, "")
    return sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)


def test_copies_are_dropped_row_by_row(spark):
    a, b, c, d, e = map(passage, range(5))
    rows = [
        (1, a), (1, a), (1, a),  # a repeated row
        (None, b), (2, b), (None, b),  # copies without an id
        (None, c), (None, c),  # no copy has one
        (3, a), (3, d),  # an id on two texts, one of them a copy
        (4, a), (5, e), (6, None), (7, ""),
    ]
    want = sorted([(4, a), (2, b), (None, c), (3, d), (5, e), (7, "")], key=str)
    assert after(spark, rows, "exact") == want
    assert after(spark, rows, "exact", "near", "repeats") == want


def test_near_copies_are_dropped_row_by_row(spark):
    a, b, c, d = map(passage, range(10, 14))
    rows = [
        (1, a), (1, changed(a)), (1, a),  # near copies that share an id
        (None, b), (2, changed(b)), (None, c), (None, changed(c)),
        (3, changed(changed(a) + " more")), (3, d),  # an id on two texts, one of them a near copy
    ]
    kept = after(spark, rows, "near")
    assert [i for i, _ in kept].count(1) == 1 and (2, changed(b)) in kept and (3, d) in kept
    assert len(kept) == 4 and sum(i is None for i, _ in kept) == 1
    assert after(spark, rows, "near", "repeats") == kept


def test_whole_run(spark, tmp_path):
    """Exact and near groups, a shared passage, nulls, repeated ids and a text without a letter."""
    names, r = ("a", "b", "c"), random.Random(1)
    alphabets = {"a": "abcdefg", "b": "hijklmn", "c": "opqrstu"}

    def text(lang, n, seed):
        q = random.Random(f"{lang}{seed}")
        return " ".join("".join(q.choice(alphabets[lang]) for _ in range(q.randint(2, 7))) for _ in range(n))

    rows = [(i, text(names[i % 3], r.randint(30, 80), i), names[i % 3]) for i in range(90)]
    hot, near, shared = text("a", 70, "hot"), text("b", 70, "near"), text("c", 90, "shared")
    rows += [(1000 + i, hot, "a") for i in range(60)] + [(2000 + i, f"{near} {text('b', 2, i)}", "b") for i in range(60)]
    rows += [(3000 + i, f"{text('c', 40, f'x{i}')} {shared} {text('c', 40, f'y{i}')}", "c") for i in range(5)]
    rows += [(None, hot, "a"), (1, rows[1][1], "b"), (4000, None, None), (4001, "12 34 !!", None), (4002, "", "a")]
    docs = spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], DOCS)
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = Counter(p.doc_id for p in out if p.start == 0)
    assert set(kept) == {*range(90), 1059, 2000, *range(3000, 3005)} and set(kept.values()) == {1}
    n = {p.doc_id: p.doc_tokens for p in out}
    ids, _ = library([t.replace(f" {shared} ", "") for i, t, _ in rows if i is not None and 3000 <= i < 3005])
    for i in range(5):  # the shared passage is gone, what is around it stays
        assert abs(n[3000 + i] - len(ids[i]) - 1) <= 4
    used = {}
    for p in out:
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for pieces in used.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0


def test_stages_keep_columns_of_any_name(spark):
    """Names that the operators use themselves come back with their own values."""
    own = ("_row", "row", "tied", "node", "keep_id", "component", "spans", "key", "lang_pred", "a.b")
    rows = [(i, passage(i)) for i in range(6)] + [(6, passage(3)), (7, changed(passage(4)))]
    docs = table(spark, rows)
    for name in own:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, "")
        assert found.columns == docs.columns, name
        for r in found.collect():
            assert all(r[c] == f"{c}{r.doc_id}" for c in own), name


def test_stages_take_an_empty_table(spark):
    docs = table(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, "")
        assert found.count() == 0
        if name != "packing":
            assert found.columns == docs.columns
