"""Hard negatives against a plain search of all rows."""

import math
import random

import pytest

from tillroll.llm import hard_negatives
from tillroll.llm.common import NULL_ID

SCHEMA = "vec_id long, embedding array<float>, label int, _id long, _vec string, rank int"


def plain(rows, k=5, every=100):
    used = {}
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not math.isfinite(x) or abs(x) >= 65536 for x in v):
            continue
        y = int(math.fmod(y + 1, 10)) if i is not None and i % 7 == 0 else y
        key = NULL_ID if i is None else i
        new = (y, [math.floor(256 * x) for x in v])
        used[key] = min(used.get(key, new), new)
    out = set()
    for a, (y, v) in used.items():
        if a == NULL_ID or a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, (z, w) in used.items() if i != a)
        for s, p, z in [x for x in scored if x[2] == y][:k]:
            near = [(t, n) for t, n, z in scored if z != y and 80 * -s <= 100 * -t <= 100 * -s][:k]
            out |= {(a, None if p == NULL_ID else p, r + 1, None if n == NULL_ID else n, -s, -t) for r, (t, n) in enumerate(near)}
    return out


def vectors(rng, n, dim=12):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    return [[float(round(c + rng.gauss(0, 0.6), 3)) for c in rng.choice(centres)] for _ in range(n)]


def run(spark, rows, **kw):
    import numpy as np
    rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]
    got = hard_negatives.mine(spark.createDataFrame([(*r, 1, "x", 2) for r in rows32], SCHEMA).repartition(3), **kw)
    got = [tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(got) == len(set(got))
    return set(got), plain(rows32, **kw)


def test_mined_rows_equal_a_plain_search(spark, monkeypatch):
    rng = random.Random(3)
    v = vectors(rng, 700)
    v[50:60] = [v[300]] * 10                                        # ties
    rows = [(i, x, rng.randrange(10)) for i, x in enumerate(v)]
    rows += [(701, None, 1), (702, v[0], None), (703, [float("nan")] * 12, 1), (704, [float("inf")] * 12, 1), (705, [None] * 12, 2),
             (706, [1e6] * 12, 3), (None, v[1], 2), (None, v[2], 3), (800, [], 2), (801, v[3][:5], 3), (900, v[4] * 2, 4),
             (3, v[9], 1), (100, v[100], 5), (100, v[100], 5), (-100, v[7], 6), (-7, v[8], -3)]
    monkeypatch.setattr(hard_negatives, "BLOCK", 128)
    got, want = run(spark, rows)
    assert got == want and len(want) > 50


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 1)], [(0, [1.0], 1), (1, [2.0], 1), (2, [1.9], 2), (100, None, 1)]])
def test_small_tables(spark, rows):
    got, want = run(spark, rows)
    assert got == want


def test_scores_beyond_the_exact_doubles(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(30000, 65000) for _ in range(40)], rng.randrange(3)) for i in range(120)]
    got, want = run(spark, rows, every=10)
    assert got == want and want


def test_bounds_hold_and_drop_most_pairs_of_smooth_vectors():
    import numpy as np
    rng = np.random.default_rng(1)
    m = (np.repeat(rng.normal(0, 60, (300, 8)), 8, axis=1) + rng.normal(0, 4, (300, 64))).astype(np.int64)
    a = hard_negatives._Side(np.arange(300), np.zeros(300), m).prepare(64)
    every = np.ones((300, 300), bool)
    exact, left = m @ m.T, []
    for level in range(len(hard_negatives.SEGMENTS)):
        low, high = hard_negatives._bounds(a, a, level, every)
        assert (low <= exact).all() and (exact <= high).all()
        left.append(((high >= hard_negatives._kth(low, 5)[:, None]).mean()))
    assert left[0] > left[1] > left[2] and left[2] < 0.1
