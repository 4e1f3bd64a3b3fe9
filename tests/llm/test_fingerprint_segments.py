"""Fingerprints of reordered paragraphs and of texts without marks."""

import random

import pytest
from pyspark.sql import functions as F

from tillroll.llm import fingerprint

from corpus_data import make, prose  # noqa: F401


def vectors(make, texts):
    rows = fingerprint.fingerprints(make(list(enumerate(texts))), ["doc_id"], "text").collect()
    return [v for _, v in sorted((r.doc_id, r.vector) for r in rows)]


@pytest.mark.parametrize("between", ["\n", "\n\n", " \n\n\t", "\n" + " " * 40])
def test_order_of_paragraphs(make, between):
    rng = random.Random(4)
    parts = ["A.", "B", "no mark at the end", "C, d; e!", prose(rng, 30)]
    other = parts[::-1]
    a, b, c, end = vectors(make, [between.join(parts), between.join(other), between.join(parts[:-1]), between.join(parts) + between])
    assert a == b and a != c
    assert end[:-fingerprint.N_SPACE] == a[:-fingerprint.N_SPACE] and end != a


def test_a_paragraph_more_is_one_insertion(make, spark):
    texts = ["A.\n\nB one", "A.\n\nB one\n\nC two", "C two", "\n\n"]
    v = spark.createDataFrame([tuple(vectors(make, texts))], "a array<long>, b array<long>, c array<long>, gap array<long>")
    add = fingerprint.add
    assert v.select(add(add(F.col("a"), F.col("c")), F.col("gap")) == F.col("b")).first()[0]
    a, b, c, gap = v.first()
    n = len(a) - fingerprint.N_SPACE
    assert b[0] == a[0] + 1 and not any(gap[:n])


def unmarked():
    rng = random.Random(7)
    words = [f"{a}{b}{c}" for a in "bcdfgt" for b in "aeiou" for c in "lmnrstk"]
    han = [chr(c) for c in range(0x4E00, 0x9F00, 7)]
    make_text = {
        "words": lambda n: " ".join(rng.choice(words) for _ in range(n // 4)),
        "han": lambda n: "".join(rng.choice(han) for _ in range(n)),
        "base64": lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n)),
        "acgt": lambda n: "".join(rng.choice("ACGT") for _ in range(n)),
        "sentences": lambda n: "".join(rng.choice(han) + rng.choice(["", "", "", "。"]) for _ in range(n * 4 // 5)),
    }
    return [f(n) for f in make_text.values() for n in (300, 1000, 5000)]


def test_each_text_without_marks_is_like_its_edit(make):
    texts = unmarked()
    got = {r.doc_id: r for r in fingerprint.edit_likeness(make(list(enumerate(texts)))).collect()}
    for k, t in enumerate(texts):
        half, after = len(t) // 2, texts[(k + 1) % len(texts)]
        length = len(t) - half + min(half, len(after))
        shared = (len(t) - half) * 2 / (len(t) + length)  # the sizes' mean is the estimate's denominator
        assert abs(got[k].near_edited - shared) < 0.3 and got[k].near_edited > 0.2, (k, got[k].near_edited, shared)


def test_an_insertion_changes_few_segments(make):
    texts = [t for t in unmarked() if len(t) > 2000]
    edited = [t[:1000] + "inserted7" + t[1000:] for t in texts]
    for a, b in zip(vectors(make, texts), vectors(make, edited)):
        assert a[0] > 40
    pairs = make([(2 * k + j, t) for k, p in enumerate(zip(texts, edited)) for j, t in enumerate(p)])
    near = {r.doc_id: r.near_next for r in fingerprint.edit_likeness(pairs).collect()}
    assert all(near[2 * k] > 0.6 for k in range(len(texts))), near


@pytest.mark.parametrize("letters", ["абвгдежзиклмнопрстуфхцчшыэюя", "가나다라마바사아자차카타파하고노도로모보소오조초코토포호", "abcdefghij"])
@pytest.mark.parametrize("gap", [" ", ""])
def test_an_insertion_in_any_script_is_local(make, letters, gap):
    rng = random.Random(3)
    text = gap.join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(600))
    edited = text[:900] + rng.choice(letters) + text[900:]
    near = {r.doc_id: r.near_next for r in fingerprint.edit_likeness(make([(1, text), (2, edited)])).collect()}
    assert near[1] > 0.9


def test_long_texts_take_linear_time_and_counters_do_not_overflow(make):
    import time
    seconds = []
    for n in (150_000, 600_000):
        t0 = time.perf_counter()
        (a,) = vectors(make, ["x " * n + "y" * n])
        seconds.append(time.perf_counter() - t0)
        assert a[0] == 2 * n - 2  # words, then runs of characters, three at a time
        lanes = [v >> s & 0xFFFFFFFF for v in a[2 + fingerprint.N_EXACT:-fingerprint.N_SPACE] for s in (0, 32)]
        assert max(lanes) <= a[0] and max(lanes) > n - 10
    assert seconds[1] < 12 * max(seconds[0], 1)


def test_edits_at_seams(make):
    """Texts whose halves end at, before and after line feeds, marks and spaces."""
    import hashlib
    rng = random.Random(12)
    texts = ["".join(rng.choice("ab \n.") for _ in range(rng.randint(0, 14))) for _ in range(120)]
    got = {r.doc_id: r for r in fingerprint.edit_likeness(make(list(enumerate(texts)))).collect()}
    edited = [t[:len(t) - len(t) // 2] + texts[(k + 1) % len(texts)][:len(t) // 2] for k, t in enumerate(texts)]
    plain = {r.doc_id: r.fingerprint for r in make(list(enumerate(edited))).transform(
        lambda d: fingerprint.fingerprints(d, ["doc_id"], "text")).select("doc_id", fingerprint.as_text(F.col("vector")).alias("fingerprint")).collect()}
    for k, t in enumerate(edited):
        assert got[k].edited_fingerprint == plain[k]
        assert got[k].edited_sha256 == hashlib.sha256(t.encode()).hexdigest()
