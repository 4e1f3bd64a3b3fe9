"""Line dedup, byte-string dedup and the Jaccard join against plain versions."""

import hashlib
import re
from collections import defaultdict

import pytest

from tillroll.llm import line_dedup, ngram_join, suffix_dedup
from tillroll.llm.common import NULL_ID

from corpus_data import corpus, make  # noqa: F401

T = suffix_dedup.THRESHOLD
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_order(rows):
    return sorted(((NULL_ID if i is None else i), t or "") for i, t in rows)


def plain_bytes(rows):
    seen, out = set(), {}
    for i, t in in_order(rows):
        b = t.encode()
        keep = bytearray(b"\1") * len(b)
        for p in range(len(b) - T + 1):
            if b[p:p + T] in seen:
                keep[p:p + T] = bytes(T)
            seen.add(b[p:p + T])
        left = bytes(x for x, k in zip(b, keep) if k)
        runs = sum(1 for j in range(len(b)) if not keep[j] and (j == 0 or keep[j - 1]))
        out[i] = (len(b), len(b) - len(left), runs, hashlib.sha256(left).hexdigest())
    return out


def got_by_id(df):
    return {(NULL_ID if r[0] is None else r[0]): tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("limit", [suffix_dedup.BUCKET_LIMIT, 1])
def test_suffix_dedup(make, corpus, limit):
    got = got_by_id(suffix_dedup.dedup_report(make(corpus), bucket_limit=limit))
    assert got == plain_bytes(corpus)


def test_suffix_dedup_small_flushes_and_pieces(make, corpus, monkeypatch):
    import numpy as np
    docs = [(i, (t or "").encode()) for i, t in in_order(corpus)]
    long = b"".join(t for _, t in docs)[:5000]
    whole = suffix_dedup.regions(np.frombuffer(long, np.uint8), np.array([0, len(long)]))
    monkeypatch.setattr(suffix_dedup, "_PIECE", 700)
    covered = set()
    for _, part, ends, base in suffix_dedup._pieces(np.frombuffer(long, np.uint8), np.array([0, len(long)])):
        _, start, _, count, _, _ = suffix_dedup.regions(part, ends)
        covered |= {base + s + j for s, c in zip(start, count) for j in range(c)}
    assert covered == set(range(len(long) - T + 1)) == {s + j for s, c in zip(whole[1], whole[3]) for j in range(c)}


def plain_sets(rows):
    out = {}
    for i, t in in_order(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def plain_classes(rows, percent=75):
    sets = plain_sets(rows)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y) and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(s), None if root(i) == NULL_ID else root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("pivots", [1, ngram_join.PIVOTS])
def test_ngram_join(make, corpus, pivots, monkeypatch):
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    assert got_by_id(ngram_join.classes(make(corpus))) == plain_classes(corpus)


def test_cells_bound_differences():
    import numpy as np
    rng = np.random.default_rng(2)
    for n in (1, 5, 300, 3000):
        pool = np.unique(rng.integers(0, 2**64, 2 * n, dtype=np.uint64))
        for _ in range(20):
            x = np.sort(rng.choice(pool, rng.integers(1, n + 1), replace=False))
            y = np.sort(rng.choice(pool, rng.integers(1, n + 1), replace=False))
            bound = ngram_join.least_difference(ngram_join.fine_cells(x), ngram_join.fine_cells(y))
            assert abs(len(x) - len(y)) <= bound <= len(np.setxor1d(x, y))
    same = np.zeros(300, np.uint64)
    assert ngram_join.least_difference(ngram_join.fine_cells(same), ngram_join.fine_cells(same)) == 0


def test_ngram_join_chains_and_frequent_shingles(make, monkeypatch):
    """A chain of texts, each near the next only, and a passage in most texts."""
    import random
    rng = random.Random(3)
    words = [f"w{k}" for k in range(140)]
    rows = [(k, " ".join(words[4 * k:4 * k + 60])) for k in range(20)]
    shared = " ".join(f"s{k}" for k in range(20))
    rows += [(100 + k, shared + " " + " ".join(f"x{rng.randrange(900)}" for _ in range(rng.randint(1, 40)))) for k in range(40)]
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    assert got_by_id(ngram_join.classes(make(rows))) == plain_classes(rows)


def plain_lines(rows, size=lambda x: sum(line_dedup.line_sizes(x)), min_words=10):
    """Lines in runs of ten words that an earlier document has as a run too, by comparing all pairs."""
    docs, out = [(i, t.split("\n") if t else []) for i, t in in_order(rows)], {}
    holders = defaultdict(list)  # of each line, in documents before
    for i, own in docs:
        sizes, gone = list(map(size, own)), set()
        starts = defaultdict(list)
        for a, x in enumerate(own):
            for k, b in holders[x]:
                starts[k].append((a, b))
        for k, at in starts.items():
            other, at = docs[k][1], set(at)
            for a, b in at:
                if (a - 1, b - 1) not in at:  # the first line of a run
                    n = 0
                    while (a + n, b + n) in at:
                        n += 1
                    assert own[a:a + n] == other[b:b + n]
                    if sum(sizes[a:a + n]) >= min_words:
                        gone |= set(range(a, a + n))
        for b, x in enumerate(own):
            holders[x].append((len(out), b))
        kept = "\n".join(x for j, x in enumerate(own) if j not in gone)
        out[i] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_line_dedup(make, corpus):
    assert got_by_id(line_dedup.report(make(corpus))) == plain_lines(corpus)


def test_line_dedup_alignment_keeps_order():
    # Lines 0..3 of the other document appear as 2, 0, 1, 3: the longest common order is 0, 1, 3.
    assert line_dedup.aligned([(2, 0), (0, 1), (1, 2), (3, 3)]) == [(0, 1), (1, 2), (3, 3)]
    assert line_dedup.aligned([]) == []


def test_line_dedup_keeps_columns(make, corpus):
    docs = make(corpus)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


@pytest.mark.parametrize("run", [suffix_dedup.dedup_report, ngram_join.classes, line_dedup.report])
def test_empty_table_and_repeated_ids(make, run):
    assert run(make([]).limit(0)).collect() == []
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    once = sorted(run(make([(1, text), (2, text)])).collect())
    again = sorted(set(run(make([(1, text), (2, text), (2, text)])).collect()))
    assert once == again
