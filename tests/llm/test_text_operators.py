"""Fingerprints, decontamination, secrets and the quality classifier."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, fingerprint, fm_quality, secret_scan
from tillroll.llm.common import NULL_ID

from corpus_data import corpus, make, prose  # noqa: F401
from test_duplicates import in_order, plain_sets


# ------------------------------------------------------------ fingerprints

def test_edits_and_fingerprints(make, corpus):
    rows = in_order(corpus)
    got = {(NULL_ID if r.doc_id is None else r.doc_id): r for r in fingerprint.edit_likeness(make(corpus)).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        half = len(t) // 2
        edited = t[:len(t) - half] + rows[(k + 1) % len(rows)][1][:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if edited == t:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, set()).add(got[i].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert len({f for fs in by_text.values() for f in fs}) == len(by_text)
    long = [got[i] for i, t in rows if len(t) > 600]
    assert sum(r.near_edited for r in long) / len(long) > 0.3 > 0.15 > sum(r.near_next for r in long) / len(long)


def test_fingerprints_add_and_subtract(make):
    texts = [(1, "a b. c d; e"), (2, "f, g"), (3, "a b. c d; ef, g"), (4, "f, ga b. c d; e")]
    v = fingerprint.fingerprints(make(texts), ["doc_id"], "text")
    row = v.groupBy().pivot("doc_id", [1, 2, 3, 4]).agg(F.first("vector"))
    both = make([(1, "a b.c d;"), (2, "x."), (3, "a b.c d;x."), (4, "x.c d;a b.")])
    w = fingerprint.fingerprints(both, ["doc_id"], "text").groupBy().pivot("doc_id", [1, 2, 3, 4]).agg(F.first("vector"))
    r = w.select((fingerprint.add(F.col("1"), F.col("2")) == F.col("3")).alias("sum"), (F.col("3") == F.col("4")).alias("order"),
                 (fingerprint.subtract(F.col("3"), F.col("2")) == F.col("1")).alias("less")).first()
    assert tuple(r) == (True, True, True) and row.count() == 1


@pytest.mark.parametrize("rows", [[], [(5, "only. one")], [(1, None), (2, "")]])
def test_fingerprints_of_small_tables(make, rows):
    out = fingerprint.edit_likeness(make(rows).limit(len(rows))).collect()
    assert len(out) == len(rows)
    assert all(r.near_next == 1 for r in out)


# ------------------------------------------------------------ decontamination

@pytest.mark.parametrize("broadcast", [decontaminate.MAX_BROADCAST, 0])
def test_contaminated(make, spark, corpus, broadcast):
    rng = random.Random(8)
    items = [(k, prose(rng, n)) for k, n in enumerate([3, 5, 6, 20, 40])] + [(50, None), (51, ""), (None, prose(rng, 30))]
    docs = list(corpus)
    for k, (_, t) in enumerate(items):
        docs.append((5000 + k, prose(rng, 300) + " " + (t or "") + " " + prose(rng, 50)))
        w = (t or "").split(" ")
        docs.append((6000 + k, prose(rng, 50) + "\n" + " ".join(w[:len(w) * 9 // 10]).upper()))
    docs.append((7000, items[0][1]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in
           decontaminate.contaminated(make(docs), bench, max_broadcast=broadcast).collect()}
    want = set()
    for i, s in plain_sets(docs).items():
        for j, x in plain_sets(items).items():
            if x and 100 * len(x & s) >= 75 * len(x):
                want.add((None if i == NULL_ID else i, None if j == NULL_ID else j, len(x), len(x & s)))
    assert got == want and len(want) >= 6
    assert decontaminate.contaminated(make([]).limit(0), bench).collect() == []
    assert decontaminate.contaminated(make(docs), bench.limit(0)).collect() == []


# ------------------------------------------------------------ secrets

def secrets_corpus():
    rng = random.Random(1)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows, truth = [], {}
    for k in range(240):
        text = prose(rng, 30)
        kind = k % 4
        found = {0: f'token = "{hexes(40)}"', 1: f"password={hexes(18)}", 2: f"user.{k}@mail{k % 9}.example.com",
                 3: f"{rng.randrange(10**15, 10**16)}"}[kind]
        rows.append((k, text + " " + found + " " + prose(rng, 10)))
        truth[k] = int(kind < 2)
    return rows, truth


def test_secret_scan(make, spark):
    rows, truth = secrets_corpus()
    found = secret_scan.scan(make(rows), secret_scan.dictionary(spark)).collect()
    by_doc = {r.doc_id: r for r in found}
    assert len(found) == len(by_doc) == len(rows)
    # Held out of the training: documents whose crc32 is divisible by 5.
    held = [k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([by_doc[k].is_secret == truth[k] for k in held]) > 0.9
    for k, t in rows:
        r = by_doc[k]
        span = t[r.start:r.start + r.n_chars]
        assert hashlib.sha256(span.encode()).hexdigest() == r.candidate_sha256


def test_secret_scan_odd_input(make, spark, corpus):
    words = secret_scan.dictionary(spark)
    assert secret_scan.scan(make([]).limit(0), words).collect() == []
    docs = make([*corpus, (9, "key 0123456789abcdefXYZ"), (9, "key 0123456789abcdefXYZ")])
    out = secret_scan.scan(docs, words, path_col=None).collect()
    assert len([r for r in out if r.doc_id == 9]) == 2
    assert all(r.score is None and r.is_secret == 0 for r in out)  # no rule labels a finding here


def test_no_python_in_native_plans(make, spark):
    docs = make([(1, "token = abcdef0123456789abcdef 1"), (2, "x")])
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    for df in (fingerprint.edit_likeness(docs), decontaminate.contaminated(docs, bench),
               secret_scan.scan(docs, secret_scan.dictionary(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval", "MapInArrow", "CartesianProduct"))


# ------------------------------------------------------------ quality

def test_scores_equal_all_pairs():
    rng = np.random.default_rng(1)
    texts = [b"a b c a", b"x", b""]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    parts = fm_quality.features(data, offsets, np.array([7.0, 1.0, 0.0]))
    m = fm_quality.Model(np.zeros(fm_quality.STATISTICS), np.ones(fm_quality.STATISTICS))
    m.w, m.v, m.w0 = rng.normal(size=m.w.shape), rng.normal(size=m.v.shape), np.array([0.3])
    where, bucket, value, stats = parts
    for d, raw in enumerate(m.raw(*parts)[0]):
        x = np.zeros(len(m.w))
        x[bucket[where == d]] = value[where == d]
        x[fm_quality.WORDS:] = m.standard(stats[d])
        on = np.flatnonzero(x)
        pairs = sum(m.v[i] @ m.v[j] * x[i] * x[j] for a, i in enumerate(on) for j in on[:a])
        assert raw == pytest.approx(0.3 + m.w @ x + pairs)


def test_quality_learns(make, spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(600):
        good = k % 3 > 0
        t = prose(rng, 60)
        rows.append((k, t if good else t.upper().replace(" ", "!! ")))
        labels.append((k, int(good)))
    labelled = spark.createDataFrame([*labels, (None, 1), (9999, 1), (3, None)], "doc_id long, quality int")
    rows += [(10_000, None), (10_001, ""), (None, "text"), (5, rows[5][1])]
    out = fm_quality.predictions(make(rows), fm_quality.train(make(rows), labelled)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    truth = dict(labels)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    none = fm_quality.predictions(make(rows), fm_quality.train(make(rows), labelled.limit(0))).collect()
    assert {r.score for r in none} == {0.5}
    model = fm_quality.train(make([]).limit(0), labelled)
    assert fm_quality.predictions(make([]).limit(0), model).collect() == []
