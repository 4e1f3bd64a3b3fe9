"""Token counts and SentencePiece against the libraries and plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from tillroll.llm import sentencepiece_viterbi as sp
from tillroll.llm import token_counts as tc

from corpus_data import corpus, make  # noqa: F401

ODD = ["", " ", "  two", "\n\n a  b \n", "日本語テスト é́ 😀", "x" * 3000, "\t\ttab", "trail ", "\x00\x01", "a" * 200 + " " * 200 + "b"]


def random_texts(n):
    rng = random.Random(2)
    return ["".join(rng.choice("abcdeethr  \n.,éß語😀<'1290_-") for _ in range(rng.randint(1, 120))) for _ in range(n)]


def model():
    with open(sp.DEFAULT_MODEL, "rb") as f:
        return sp.Model(f.read())


def test_ids_equal_the_library():
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=sp.DEFAULT_MODEL)
    texts = ODD + random_texts(800)
    m = model()
    assert m.encode(texts) == lib.encode(texts)
    assert [m.decode(x) for x in m.encode(texts)] == texts
    assert [m.decode(x) for x in lib.encode(texts)] == [lib.decode(x) for x in lib.encode(texts)]


def test_a_worker_keeps_no_words_after_a_task():
    import pyarrow as pa

    class Data:
        with open(sp.DEFAULT_MODEL, "rb") as f:
            value = f.read()
    texts = random_texts(60) + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    out = list(sp._encode(iter([batch, batch]), Data, 1, ["id", "text", "ids", "n"]))
    assert sum(b.num_rows for b in out) == 2 * len(texts)
    assert out[0].column(2).to_pylist()[:5] == model().encode(texts[:5])
    held = sp._model(Data.value)
    assert not held.words and not held.older and not held.kept and not held._fits


def test_unigram_mode_finds_the_best_sum():
    m = model()
    m.mode = sp.UNIGRAM
    m.scores = [-(1 + (7919 * i) % 97) / 10 for i in range(len(m.pieces))]

    def best(word):
        total = [(0.0, [])]
        for i in range(1, len(word) + 1):
            options = [(total[s][0] + m.scores[m.id_of[word[s:i]]], total[s][1] + [m.id_of[word[s:i]]])
                       for s in range(i) if word[s:i] in m.id_of]
            total.append(max(options, key=lambda x: x[0]))
        return total[-1][0]
    words = sorted({"▁" + w for t in random_texts(40) for w in t.split() if set(w) <= m.chars and all(c in m.id_of for c in w)})
    m.encode_words(words)
    for w in words:
        ids = memoryview(m.words[w]).cast("i").tolist()
        assert "".join(m.pieces[i] for i in ids) == w
        assert sum(m.scores[i] for i in ids) == pytest.approx(best(w))


def test_encode_and_decode_frames(make, corpus):
    docs = make(corpus).withColumn("n_tokens", F.lit("clash"))
    back = sp.decode(sp.encode(docs)).collect()
    assert len(back) == len(corpus)
    assert all(r.decoded == (r.text or "") and len(r.token_ids) == r.n_tokens for r in back)
    assert sp.encode(docs.limit(0)).collect() == []
    assert all(r.exact for r in sp.round_trip(make(corpus)).collect())


def encoder():
    with open(tc.DEFAULT_RANKS, "rb") as f:
        return tc._encoder(f.read())


def test_token_spans_equal_the_tokenizers_offsets():
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    enc, size = encoder()
    for text in ODD[1:] + random_texts(300):
        got = list(zip(*(x.tolist() for x in tc.token_spans(text, enc, size))))
        want = lib.encode(text, add_special_tokens=False).offsets
        assert len(got) == len(want)
        # Where characters are split among tokens the library's offsets may leave a part out.
        assert all(g == tuple(w) for g, w, in zip(got, want) if text[w[0]:w[1]].isascii() and w[1] > w[0])


def plain(spans, sections, rule):
    count, share = [0] * (len(sections) + 1), [0.0] * (len(sections) + 1)
    for a, b in spans:
        where = [next((k for k, (s, e) in enumerate(sections) if s <= c < e), len(sections)) for c in range(a, b)]
        for k in where:
            share[k] += 1 / (b - a)
        home = where[0] if rule == "start" else max(sorted(set(where)), key=where.count)
        count[home] += 1
    return count, share


@pytest.mark.parametrize("rule", tc.RULES)
def test_allocation_against_characters(rule):
    import numpy as np
    rng = random.Random(4)
    for _ in range(200):
        cuts = sorted(rng.sample(range(60), 12))
        spans = [(a, b) for a, b in zip(cuts, cuts[1:])]
        marks = sorted(rng.sample(range(61), 8))
        sections = [(marks[i], marks[i + 1]) for i in range(0, 8, 2 if rng.random() < .5 else 1) if i < 7]
        got = tc.allocate(*np.array(spans).T, *np.array(sections).T, rule)
        count, share = plain(spans, sections, rule)
        assert got[0].tolist() == count
        assert got[1].tolist() == pytest.approx(share)


def test_token_counts_frame(make, corpus):
    enc, size = encoder()
    rows = tc.token_counts(make(corpus)).collect()
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    assert total == {i: len(tc.token_spans(t or "", enc, size)[0]) for i, t in corpus}
    assert tc.token_counts(make([]).limit(0)).collect() == []
    spans = make([(1, "alpha beta gamma"), (2, None)]).withColumn(
        "sections", F.array(F.struct(F.lit(0).alias("start"), F.lit(8).alias("end"))))
    got = {(r.doc_id, r.section): r.n_tokens for r in tc.token_counts(spans, sections="sections").collect()}
    assert got[1, 0] + got[1, None] == total_tokens("alpha beta gamma") and got[2, 0] == 0
    with pytest.raises(ValueError):
        tc.token_counts(spans, rule="none")


def total_tokens(text):
    return len(encoder()[0].encode_ordinary(text))


def test_unspaced_texts_and_a_small_byte_bound(monkeypatch):
    """Whole texts as words: ids as the library's, and what is kept stays under the bound."""
    import random
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=sp.DEFAULT_MODEL)
    monkeypatch.setattr(sp, "KEPT_BYTES", 20_000)
    monkeypatch.setattr(sp, "LONG", 60)
    with open(sp.DEFAULT_MODEL, "rb") as f:
        model = sp.Model(f.read())
    rng = random.Random(5)
    for _ in range(40):
        texts = ["".join(rng.choice("漢字仮名交abcé的一是不了在人有我😀ßtheing") for _ in range(rng.randint(0, 400))) for _ in range(6)]
        texts += [" ".join("".join(rng.choice("aeioulnst") for _ in range(rng.randint(1, 9))) for _ in range(60))]
        assert model.encode(texts) == [lib.encode(t) for t in texts]
        kept = sum(len(w) * 4 + len(x) for d in (model.words, model.older) for w, x in d.items())
        assert kept < 2 * 20_000 + 30_000 and all(len(w) <= 60 for d in (model.words, model.older) for w in d)


def test_a_long_unspaced_text_takes_linear_time():
    import time
    with open(sp.DEFAULT_MODEL, "rb") as f:
        model = sp.Model(f.read())
    seconds = []
    for n in (50_000, 200_000):
        t0 = time.perf_counter()
        (ids,) = model.encode(["internationalization" * (n // 20)])
        seconds.append(time.perf_counter() - t0)
        assert model.decode(ids) == "internationalization" * (n // 20) and not model.words
    assert seconds[1] < 10 * seconds[0]
