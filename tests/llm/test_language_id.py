"""Language identification: Viterbi against all paths, spans, held-out accuracy, odd rows."""

import itertools
import random
import time
import zlib

import numpy as np
import pytest

from tillroll.llm import language_id as li

SYLLABLES = {"aa": "the ing and er ou th st ly wh re".split(), "bb": "der ein sch ung ich cht ge mit über".split(),
             "cc": "le que eau ment é oi ss ai re".split()}
SCHEMA = "doc_id long, text string, lang string, score string, lang_pred int, _text string, start long"


def words(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(4)
    return [(k, words(rng, lang, rng.randint(1, 80)), lang) for k, lang in enumerate(list(SYLLABLES) * 60)]


@pytest.fixture(scope="module")
def model(spark, labelled):
    return li.train(table(spark, [*labelled, (900, "ελληνικά γράμματα", "gr"), (901, "漢字仮名", "ja"), (902, None, "aa"), (903, "x", None)]))


def plain_best(scores, switch):
    return max(sum(scores[t][k] for t, k in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))
               for path in itertools.product(range(len(scores[0])), repeat=len(scores)))


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(0)
    counts = [0, 1, 5, 3, 6, 0, 2]
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    scores = rng.normal(0, 2, (sum(counts), 3)).astype(np.float32)
    for switch in (0.0, 1.5, 50.0):
        label = li.viterbi(scores, first, np.array(counts), switch)
        for a, n in zip(first, counts):
            if n:
                own, path = scores[a:a + n], label[a:a + n]
                got = sum(own[t][k] for t, k in enumerate(path)) - switch * (np.diff(path) != 0).sum()
                assert got == pytest.approx(plain_best(own, switch), abs=1e-3)


def test_words_against_a_plain_cut():
    texts = ["Ab, cd1é\n", "", "x" * 60, "漢字kana かな", "İstanbul ÀB", "12 --", "áb"]
    w = li.Words(texts)
    got = []
    for k in range(len(w.first)):
        at = w.at[w.first[k]:w.first[k] + w.size[k]]
        assert (np.diff(at) == 1).all()
        base = w.offsets[w.text[k]]
        got.append((int(w.text[k]), int(at[0] - base), int(at[-1] - base) + 1))
    want = [(0, 0, 2), (0, 4, 6), (0, 7, 8), (2, 0, 24), (2, 24, 48), (2, 48, 60), (3, 0, 2), (3, 2, 6), (3, 7, 9), (4, 0, 8),
            (4, 9, 11), (6, 0, 3)]
    assert got == want


def test_grams_equal_by_content_and_do_not_reach_over_words(monkeypatch):
    w = li.Words(["abcd xabcd", "abcd"])
    per_order = list(w.grams(0, len(w.at), 1 << 16))
    for n, bucket in enumerate(per_order):
        assert (bucket[:4] == bucket[-4:]).all()                    # the same word
        assert bucket[8] == bucket[3]                               # "abcd" ends the longer word: n-grams of up to four
        assert n == 0 or bucket[5] != bucket[0]                     # x before a, nothing before a
    monkeypatch.setattr(li, "BLOCK", 3)
    parts = [list(w.grams(lo, hi, 1 << 16)) for _, _, lo, hi in w.blocks()]
    assert all((np.concatenate([p[n] for p in parts]) == per_order[n]).all() for n in range(li.ORDERS))


def test_spans_of_mixed_text(spark, model):
    rng = random.Random(8)
    parts = [(lang, words(rng, lang, 30)) for lang in ("aa", "cc", "bb", "aa")]
    text, cuts = "", []
    for lang, t in parts:
        cuts.append((len(text), len(text) + len(t), lang))
        text += t + ".\n"
    got = [tuple(r)[1:] for r in li.spans(table(spark, [(1, text, None), (2, "  ", None), (3, None, None)]), model).orderBy("start").collect()]
    assert [g[2] for g in got] == [c[2] for c in cuts]
    assert all(abs(g[0] - c[0]) <= 25 and abs(g[1] - c[1]) <= 25 for g, c in zip(got, cuts))
    assert got[0][0] == 0 and got[-1][1] == len(text) - 2


def test_scripts_narrow_the_languages(spark, model):
    rows = [(1, "ελληνικά", None), (2, "仮名", None), (3, "кириллица", None), (4, "123 ...", None), (5, None, None), (6, "", None)]
    docs = table(spark, rows)
    got = {r.doc_id: r for r in li.predict(docs, model, [docs.doc_id]).collect()}
    assert [got[k].lang_pred for k in (1, 2)] == ["gr", "ja"]
    assert got[3].lang_pred in model.names and 0 < got[3].score <= 1       # no language has the script
    assert all((got[k].lang_pred, got[k].score) == ("und", 0.0) for k in (4, 5, 6))


def test_predictions_hold_out_a_fold(spark, labelled):
    rng = random.Random(5)
    rows = labelled + [(1000 + k, words(rng, lang, rng.randint(1, 6)), lang) for k, lang in enumerate(list(SYLLABLES) * 40)]
    rows += [(None, "the ing", "aa"), (7, labelled[7][1], labelled[7][2]), (2000, None, "aa"), (2001, "…", "bb")]
    wrong = [(i, t, "zz" if i is not None and zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    out = li.predictions(table(spark, wrong)).collect()
    assert len(out) == len(rows)
    truth = {i: lang for i, _, lang in rows}
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.lang_pred in ("aa", "bb", "cc", "und") and 0 <= r.score <= 1  # labels of the fold teach nothing
    held = [r for r in out if r.held_out and r.lang_pred != "und"]
    assert len(held) > 50 and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


@pytest.mark.parametrize("rows", [[], [(1, "a word", None)], [(2, None, None)]])
def test_without_labels(spark, rows):
    out = li.predictions(table(spark, rows)).collect()
    assert len(out) == len(rows) and all((r.lang_pred, r.score) == ("und", 0.0) for r in out)


def test_a_sample_bounds_what_is_learned(spark, labelled):
    small = li.train(table(spark, labelled), max_per_language=20)
    assert small.names == ["aa", "bb", "cc"]
    docs = table(spark, labelled)
    out = li.predict(docs, small, [docs.lang]).collect()
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.9


def test_very_long_text_takes_linear_time(model):
    rng = random.Random(1)
    text = words(rng, "bb", 2000)
    times = []
    for n in (20, 80):
        t0 = time.perf_counter()
        (_, w, label), = li._labelled([text * n + "x" * 100_000], model, 6.0)
        times.append(time.perf_counter() - t0)
        assert (label[:2000 * n] == 1).mean() > 0.99
    assert times[1] < 12 * times[0]


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(li, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError):
        li.train(table(spark, [(k, "a", f"l{k}") for k in range(4)]))
