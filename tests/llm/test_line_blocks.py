"""Line dedup against every run of lines of every pair of documents."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest

from tillroll.llm import line_dedup

from corpus_data import corpus, make  # noqa: F401
from test_duplicates import in_order


def common_blocks(rows, size):
    """Lines in runs of ten words that an earlier document has as a run too, by comparing all pairs."""
    docs = [(i, t.split("\n") if t else []) for i, t in in_order(rows)]
    drop = {}
    for k, (i, own) in enumerate(docs):
        gone = set()
        for _, other in docs[:k]:
            for a in range(len(own)):
                for b in range(len(other)):
                    n = 0
                    while a + n < len(own) and b + n < len(other) and own[a + n] == other[b + n]:
                        n += 1
                    if sum(map(size, own[a:a + n])) >= 10:
                        gone |= set(range(a, a + n))
        drop[i] = "\n".join(x for j, x in enumerate(own) if j not in gone)
    return drop


def left(make, rows):
    return {(line_dedup.NULL_ID if r.doc_id is None else r.doc_id): r.text or "" for r in line_dedup.dedup_lines(make(rows)).collect()}


def scattered():
    """Documents of few different lines, with blank lines, scattered single lines, moved blocks and copies."""
    rng = random.Random(5)
    lines = ["", "", "one", "two words", "a line of just six words", "another line that has six words",
             "this line has eleven words so it is its own block"]
    rows = [(k, "\n".join(rng.choice(lines) + rng.choice(["", "", " x", " y"]) for _ in range(rng.randint(0, 14)))) for k in range(40)]
    return rows + [(100 + k, rows[k][1]) for k in range(10)]


def words(line):
    return len(line.split())


def test_blocks_of_all_pairs(make):
    rows = scattered()
    want = common_blocks(rows, words)
    assert left(make, rows) == want
    assert any(want[i] != t for i, t in rows)


def test_block_whose_lines_are_scattered_over_earlier_documents(make):
    x, y = "first line of six words here", "second line of six words here"
    assert left(make, [(1, x), (2, y), (3, f"{x}\n{y}"), (4, f"z\n{x}\n{y}")])[4] == "z"


def test_exact_copies_keep_nothing(make):
    rows = scattered()
    got = left(make, rows)
    copies = [k for k in range(10) if sum(map(words, rows[k][1].split("\n"))) >= 10]
    assert copies and all(got[100 + k] == "" for k in copies)


def test_alignments_of_all_pairs_delete_no_more(make, corpus):
    got = left(make, corpus)
    docs = in_order(corpus)
    for k, (i, t) in enumerate(docs):
        own = t.split("\n")
        for _, other in docs[:k]:
            other = other.split("\n")
            for m in SequenceMatcher(None, other, own, autojunk=False).get_matching_blocks():
                block = own[m.b:m.b + m.size]
                if sum(map(words, block)) >= 10:
                    assert "\n".join(block) not in got[i]


def test_shortest_runs():
    first, last = line_dedup.shortest_runs(np.array([10, 0, 3, 0, 8]), 10)
    assert list(zip(first.tolist(), last.tolist())) == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 4), (2, 4)]
    assert len(line_dedup.shortest_runs(np.array([4, 5]), 10)[0]) == 0


def test_repeated_lines_do_not_break_a_block(make):
    x, y = "first line of six words here", "second line of six words here"
    assert left(make, [(1, f"{x}\n\n{y}"), (2, f"Intro\n\n{x}\n\n{y}")])[2] == "Intro\n"
    assert left(make, [(1, f"{x}\n--\n{y}\n--"), (2, f"--\n--\n{x}\n--\n{y}\n--\nend")])[2] == "--\n--\nend"


def test_short_lines_and_scripts_without_spaces(make):
    table = "\n".join(f"row {k}" if k % 2 else f"r{k}" for k in range(60))
    han, thai = "漢字かな交じりの文章は空白なしで書かれる。", "ภาษาไทยเขียนติดกันไม่เว้นวรรค"
    rows = [(1, table), (2, "head\n" + table + "\ntail"), (3, han), (4, "a\n" + han), (5, thai), (6, thai + "\nb"),
            (7, "漢字"), (8, "漢字")]
    got = left(make, rows)
    assert got == dict(rows) | {2: "head\ntail", 4: "a", 6: "b"}
    assert got == {i: t for i, t in common_blocks(rows, lambda x: sum(line_dedup.line_sizes(x))).items()}


def test_patience_blocks():
    a, b = list("abcdefgh"), list("xbcdeyfgh")
    assert line_dedup.patience(list(map(ord, a)), list(map(ord, b))) == [(1, 1, 4), (5, 6, 3)]
    assert line_dedup.patience([1, 1, 2], [1, 2, 2]) == [(0, 0, 1), (2, 2, 1)]
    assert line_dedup.patience([], [1]) == []
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(8) for _ in range(rng.randint(0, 15))] for _ in range(2))
        end = (0, 0)
        for i, j, n in line_dedup.patience(a, b):
            assert i >= end[0] and j >= end[1] and a[i:i + n] == b[j:j + n]
            end = (i + n, j + n)
        same = line_dedup.patience(a, a)
        assert same == ([(0, 0, len(a))] if a else [])


@pytest.mark.parametrize("rare", [1, 2, 6, 1000])
def test_rare_and_frequent_lines_together_give_all_blocks(make, monkeypatch, rare):
    """Whatever counts as rare, what goes is the same; with 1 there are no pairs, with 1000 no frequent lines."""
    monkeypatch.setattr(line_dedup, "RARE", rare)
    rows = scattered()
    assert left(make, rows) == common_blocks(rows, words)


def test_pairs_give_moved_and_repeated_blocks():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (np.array([rng.randrange(7) for _ in range(rng.randint(1, 14))], np.uint64) for _ in range(2))
        size = np.array([int(x) % 4 for x in b])
        want = set()
        for j in range(len(b)):
            for i in range(len(a)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                if size[j:j + n].sum() >= 5:
                    want |= set(range(j, j + n))
        got = {k for x, y in line_dedup.common_runs(a, b, size, 5) for k in range(x, y + 1)}
        assert got == want


def test_many_blank_lines_take_linear_time(make):
    import time
    seconds = []
    for n in (20_000, 80_000):
        text = "this line has more than ten words so that it is a block\n" + "\n" * n + "another line that has more than ten words of its own here"
        t0 = time.perf_counter()
        assert left(make, [(1, text), (2, "a\n" + text)]) == {1: text, 2: "a"}
        seconds.append(time.perf_counter() - t0)
    assert seconds[1] < 8 * max(seconds[0], 1)


CLASHING = ["_hit", "_key", "_drop", "_n", "_bno", "_bn", "_bm", "_pipeline_key", "_fm_text", "_fm_chars", "_fm_quality_score", "_score",
            "_line_dedup_n", "_line_dedup_key", "_line_dedup_drop", "a.b", "_Hit"]


def test_internal_names_are_free(spark):
    line = "this line has more than ten words so that it is a block of its own"
    names = [c for c in CLASHING if c != "_Hit"]
    docs = spark.createDataFrame([(k, f"{k}\n{line}", *(f"{c}{k}" for c in names)) for k in range(4)], ["doc_id", "text", *names])
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(k, f"0\n{line}" if k == 0 else str(k), *(f"{c}{k}" for c in names)) for k in range(4)]
