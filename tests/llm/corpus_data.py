"""Made-up prose for the tests."""

import random

import pytest

WORDS = "the of and to in is that for it with as was on be at by this had not are but from or have an they which".split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        w = rng.choice(WORDS) + rng.choice(["", "", "er", "ing", "é", "tion"]) * rng.randint(0, 2)
        out.append(w + rng.choice([" "] * 8 + [". ", ".\n", ", "]))
    return "".join(out).strip()


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, _text string, score string"

@pytest.fixture(scope="session")
def make(spark):
    """Documents, with columns whose names clash with internal ones, from (doc_id, text) pairs."""
    def run(rows, parts: int = 3):
        data = [(i, t, "en", f"s{k}", None if t is None else len(t), 1, "x", "y") for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(data, DOC_SCHEMA).repartition(parts)
    return run


@pytest.fixture(scope="session")
def corpus():
    """Prose with exact and near copies, shared passages and lines, odd rows."""
    rng = random.Random(11)
    base = [prose(rng, rng.randint(1, 160)) for _ in range(60)]
    passage, line = prose(rng, 70), "a line that many documents share word for word, more than ten words"
    rows = list(base)
    for k in range(40):
        t = rng.choice(base)
        kind = k % 5
        if kind == 0:
            rows.append(t)
        elif kind == 1:
            w = t.split(" ")
            w[rng.randrange(len(w))] = "changed"
            rows.append(" ".join(w))
        elif kind == 2:
            rows.append(prose(rng, 30) + " " + passage + " " + prose(rng, 30))
        elif kind == 3:
            rows.append(prose(rng, 20) + "\n" + line + "\n" + prose(rng, 20) + "\n" + line)
        else:
            rows.append(t[:len(t) // 2] + prose(rng, 10))
    rows += ["", None, "one", "one", "two words", "ab" * 400, "ab" * 300, "\n\n\n", "é" * 130, "é" * 130, "UPPER Case words five six",
             "upper case words FIVE six", prose(rng, 4000)]
    return [(1000 - 3 * k, t) for k, t in enumerate(rows)] + [(None, base[3])]
