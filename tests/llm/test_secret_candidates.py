"""Candidates of the secret scan that have no digit, few characters or other marks."""

import random
import re
import time

import pytest

from tillroll.llm import secret_scan

from corpus_data import make, prose  # noqa: F401

PLANTED = {
    'password="correct-horse-battery"': "correct-horse-battery",
    'token = "QwErTyUiOpAsDfGhJkLz"': "QwErTyUiOpAsDfGhJkLz",
    "password = S3cr3t!9": "S3cr3t!9",
    "password = pass$word#2024!x": "pass$word#2024!x",
    "secret: 'a*b%c!d:e'": "a*b%c!d:e",
    "see QwErTyUiOpAsDfGhJkLz there": "QwErTyUiOpAsDfGhJkLz",
    "pwd: 7a!": "7a!",
    "key=0123456789abcdef0123": "0123456789abcdef0123",
}


def test_secrets_of_all_forms_are_candidates(make):
    texts = [f"some words before {t} and after" for t in PLANTED]
    found = secret_scan.candidates(make(list(enumerate(texts)))).collect()
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r.candidate)
        assert texts[r.doc_id][r.start:r.start + len(r.candidate)] == r.candidate
    assert by_doc == {k: [v] for k, v in enumerate(PLANTED.values())}


def test_short_texts(make):
    found = secret_scan.candidates(make([(1, "pwd=a1b2c3"), (2, "pin"), (3, "token ="), (4, "")])).collect()
    assert [(r.doc_id, r.start, r.candidate) for r in found] == [(1, 4, "a1b2c3")]


KEY = re.compile(r"passw(or)?d|pwd|token|secret|api_?key|access_?key|auth|bearer|credential", re.I)
RUN = re.compile(r"[A-Za-z0-9+/=_.@\-]{12,}")


def plain_mixed(x):
    return bool(re.search("[0-9]", x) or (re.search("[a-z]", x) and re.search("[A-Z]", x)))


def plain_name(x):
    x = x.rstrip("\"'])")
    return re.search(r"[A-Za-z0-9_.\-]*$", x)[0]


def plain_assigned(word):
    for k, c in enumerate(word):
        if c in "=:":
            name, rest = word[:k], word[k:]
            sign = next((s for s in (":=", "=>", "=", ":") if rest.startswith(s) and len(rest) > len(s)
                         and not (s == ":" and rest.startswith("://"))), None)
            if sign and re.search("[A-Za-z]", plain_name(name)):
                return name, rest[len(sign):]
            return "", ""
    return "", ""


def plain_candidates(text):
    words = [(m.start(), m[0]) for m in re.finditer(r"\S+", text, re.ASCII)]
    sign = {"=", ":", "=>", ":="}

    def key_end(w):
        for s in ("=>", ":=", "=", ":"):
            if w.endswith(s):
                w = w[:len(w) - len(s)]
                break
        return bool(KEY.search(plain_name(w)))
    out = []
    for i, (at, w) in enumerate(words):
        one, two = (words[i - k][1] if i >= k else "" for k in (1, 2))
        after_key = key_end(one) or (one in sign and key_end(two))
        name, given = plain_assigned(w)
        whole = given if given and (KEY.search(plain_name(name)) or not after_key) else w if after_key else ""
        value = whole.lstrip("\"'`({[<").rstrip(")}]>,;.").rstrip("\"'`")
        found = [value] if value and value not in sign else []
        for r in RUN.findall(w):
            if plain_mixed(r):
                m = re.match(r"^[A-Za-z_.\-]+=(.{8,})$", r)
                r = m[1] if m else r
                if plain_mixed(r) and r not in value:
                    found.append(r)
        out += [(at + w.index(c), c) for c in found]
    return sorted(out)


def test_candidates_equal_a_plain_scan(make):
    rng = random.Random(6)
    bits = ["token", "password", "Secret", "user_key", "auth:", "pwd=", "=", ":", "=>", ":=", "\n", "\n\n", "\t", " ", " ", " ", "  ", "a1b2c3d4e5f6g7",
            "QwErTyUiOpAs", "x", "'", '"', "(", ")", "]", ",", ".", ";", "http://a.bc/de?f=1", "é", "b", "-", "_", "9", "name=", "api_key", "k:v"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(400)]
    texts += ["x pwd=pa$s!\n\nnext", "password:\n\nhunter2!", "password:\nhunter2!", "token =\n\n\n 'abc'"]
    texts += [" ".join(f"key{k}=v{k}" for k in range(3000)) + " token z"]     # over a block of words
    got = {}
    for r in secret_scan.candidates(make(list(enumerate(texts)))).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.candidate))
    assert {k: sorted(v) for k, v in got.items()} == {k: c for k, t in enumerate(texts) if (c := plain_candidates(t))}
    assert got[400] == [(6, "pa$s!")] and got[401] == [(11, "hunter2!")]


@pytest.mark.parametrize("unit", ["a", "=", "a=", "token", "'", "a1B/", "x:y ", "token: v ", ",", "k=v "])
def test_long_texts_take_linear_time(make, unit):
    seconds = []
    for n in (50_000, 200_000):
        t0 = time.perf_counter()
        secret_scan.candidates(make([(1, "password: " + unit * (n // len(unit)) + "! b")])).agg({"start": "max"}).collect()
        seconds.append(time.perf_counter() - t0)
    assert seconds[1] < 8 * max(seconds[0], 1.5), seconds


def test_words_run_together_are_covered(make, spark):
    words = spark.createDataFrame([(w,) for w in ("correct", "horse", "rect")], "piece string")
    found = spark.createDataFrame([("correcthorse",), ("XcorrectY9horse!",), ("zzzz",), ("a" * 300_000,)], "candidate string")
    got = {r.candidate: r._covered for r in secret_scan.coverage(found, words).collect()}
    assert got == {"correcthorse": 12, "XcorrectY9horse!": 12}


def test_planted_findings_of_other_documents(make, spark):
    rng = random.Random(3)
    docs = make([(k, prose(rng, 60)) for k in range(400)])
    words = secret_scan.dictionary(spark)
    labelled = secret_scan.planted_findings(docs, words, max_documents=150)
    held = secret_scan.planted_findings(docs, words, max_documents=60, held_out=True)
    assert labelled.select("doc_id").intersect(held.select("doc_id")).count() == 0
    out = secret_scan.score(held, secret_scan.train(labelled)).select("label", "is_secret", "f_key_word").collect()
    kinds = {(r.label, r.f_key_word) for r in out}
    assert kinds == {(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)}  # the label is not the key word's
    assert sum(r.label == r.is_secret for r in out) / len(out) > 0.93


def test_short_secrets_are_not_shown(make, spark):
    docs = make([(1, "pwd=abc token = 12345678 secret: 'correct-horse-battery-staple'")])
    shown = {r.n_chars: r.shown for r in secret_scan.scan(docs, secret_scan.dictionary(spark)).collect()}
    assert shown[3] == "..." and shown[8] == "12..." and shown[28] == "corr..."
