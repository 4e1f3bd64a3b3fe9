"""The Jaccard join's regions, cells and windows against all pairs."""

import random

import numpy as np
import pytest

from tillroll.llm import ngram_join

from corpus_data import corpus, make, prose  # noqa: F401
from test_duplicates import got_by_id, plain_classes


def groups(seed):
    """Groups of variants of one text, from links of all pairs to none, with shared passages and a first text apart."""
    rng = random.Random(seed)
    rows = []
    shared = [" ".join(f"p{g}x{k}" for k in range(25)) for g in range(3)]
    for g in range(6):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(60)]
        for _ in range(rng.randint(5, 40)):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
            rows.append(" ".join(w) + " " + rng.choice(shared))
    rows += [shared[0] + " " + prose(rng, rng.randint(1, 9)) for _ in range(60)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, few, small, pivots, shrink, block, chunk", [
    (0, 1, 0, 2, 0.8, 3, 7), (4, 6, 3, 8, 0.99, 64, 4096), (1000, 3, 5, 16, 0.0, 8, 16)])
def test_regions_go_on_in_rounds(make, monkeypatch, seed, few, small, pivots, shrink, block, chunk):
    for name, value in {"FEW": few, "SMALL": small, "SHRINK": shrink, "PIVOTS": pivots, "PIVOT_BLOCK": block, "CHUNK": chunk, "CELL_BYTES": 2000}.items():
        monkeypatch.setattr(ngram_join, name, value)
    rows = groups(seed)
    got = got_by_id(ngram_join.classes(make(rows)))
    assert got == plain_classes(rows)
    assert 10 < len({c for _, c in got.values()}) < len(rows)


def test_frequent_shingles_only_order(make, monkeypatch):
    rows = groups(7)
    monkeypatch.setattr(ngram_join, "FREQUENT_SHARE", 0.0)  # shingles of eight documents are frequent
    monkeypatch.setattr(ngram_join, "COUNTED_SHINGLES", 3000)
    assert got_by_id(ngram_join.classes(make(rows))) == plain_classes(rows)


def test_words_over_64_kib_differ_by_their_order(make):
    a, b = "a" * 65536, "b" * 65536
    got = got_by_id(ngram_join.classes(make([(1, a + b), (2, b + a), (3, a + b)])))
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 1)}


def test_windows_never_close_on_a_link():
    rng = np.random.default_rng(6)
    pool = np.unique(rng.integers(0, 2**64, 3000, dtype=np.uint64))
    for n in (3, 40, 900):
        sets = []
        for _ in range(12):
            base = rng.choice(pool, n, replace=False)
            for drop in (0, n // 20, n // 8, n // 3):
                sets.append(np.sort(np.concatenate([base[drop:], rng.choice(pool, drop)])))
        sets = [np.unique(s) for s in sets]
        import pyarrow as pa
        ids = np.arange(len(sets))

        def members(chosen):
            return ngram_join._Members(pa.RecordBatch.from_arrays([
                pa.array(ids), pa.array(ids), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.float64()),
                pa.array([len(s) for s in sets]), pa.array([ngram_join.coarse_cells(s) for s in sets], pa.binary()),
                pa.array([chosen] * len(ids))], names=list("abcdefg")))
        near = set(zip(*(x.tolist() for x in ngram_join.windows(members(True), members(True), 75)[:2])))
        for i in ids:
            for j in ids[i + 1:]:
                both = len(np.intersect1d(sets[i], sets[j]))
                if 4 * both >= 3 * (len(sets[i]) + len(sets[j]) - both):
                    assert (i, j) in near
        assert len(near) < len(ids) ** 2 / 4


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_components_in_one_task_and_in_rounds(spark, monkeypatch, most):
    monkeypatch.setattr(ngram_join, "TASK_LINKS", most)
    rng = random.Random(most)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)]
    edges = [(a, b) for a, b in edges if a != b]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r[0]: r[1] for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert got == {x: root(x) for x in parent}
