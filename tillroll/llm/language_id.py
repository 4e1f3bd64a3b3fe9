"""Language identification of mixed-language texts: candidates by script, then Viterbi over words.

A word is a run of letters (and their marks) of one script, at most WORD characters of it.  Its
score for a language is the mean log likelihood sum over the orders 1 to ORDERS of its character
n-grams, hashed to a fixed number of buckets, less that of its best language, and not under -CLIP.
Languages that write under CANDIDATE_SHARE of their letters in the word's script are no candidates
(-FLOOR), unless no language has the script.  Viterbi then labels the words: the path with the largest sum of
scores, where each change of language costs ``switch``; ties stay, and go to the smaller name.
Adjoining words of one language are a span.  A document's language is that with the most letters in
its spans, and its score the share of the letters that these have.

Viterbi runs over the words of all documents of a batch at once, in numpy: step t takes the t-th word
of every document that has one.  Memory follows the batch's bytes times the languages, both bounded
(BATCH_CELLS; a single longer text is handled alone, its n-grams by the block).

The model is learned from at most about ``max_per_language`` texts of each language (expected
number; by a hash), and has at most MODEL_CELLS numbers whatever the input; more than MAX_LANGUAGES
languages are an error.  Counts are added up within tasks and then by Spark.

Results for odd input: null texts and texts without a letter are ``und`` with score 0 and have no
spans; without labelled texts all are; rows are judged one by one, so repeated rows give
repeated rows and null ids stay null; labels that are null teach nothing, empty labels are a language
like others; an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import written

ORDERS = 4
WORD = 24
CLIP, FLOOR = 12.0, 24.0
SWITCH = 6.0
SMOOTHING = 0.5
CANDIDATE_SHARE = 0.001
MAX_PER_LANGUAGE = 20_000
MAX_LANGUAGES = 1024
MODEL_CELLS = 1 << 22       # buckets times languages
MAX_BUCKETS = 1 << 17
BATCH_CELLS = 1 << 27       # bytes of text times languages that Viterbi handles at once
BLOCK = 1 << 20             # letters whose n-grams are handled at once
UNDETERMINED = "und"
# Blocks of code points by script (first, last).
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F), (0xFB13, 0xFB17)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "oriya": [(0xB00, 0xB7F)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "myanmar": [(0x1000, 0x109F), (0xAA60, 0xAA7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)],
    "ethiopic": [(0x1200, 0x139F), (0x2D80, 0x2DDF)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}
COMMON, ANY = 0, 255        # letters of no listed script; marks that go with any
_TOP = 0x40000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_FINAL = np.uint64(0xFF51AFD7ED558CCD)
_tables: list[np.ndarray] = []


def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: whether it is part of words, and its script."""
    if not _tables:
        script = np.zeros(_TOP, np.uint8)
        for k, ranges in enumerate(SCRIPTS.values()):
            for first, last in ranges:
                script[first:last + 1] = k + 1
        part = np.zeros(_TOP, bool)
        part[0x20000:] = True
        for c in range(0x20000):
            kind = unicodedata.category(chr(c))[0]
            part[c] = kind in "LM"
            if kind == "M" and script[c] == COMMON:
                script[c] = ANY
        _tables[:] = [part, script]
    return _tables[0], _tables[1]


def _lowered(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[:1] for c in text)  # one for one


class Words:
    """The words of some texts: where each begins, its letters, its script and its text's number."""

    def __init__(self, texts: list[str]):
        part, script = _characters()
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))  # texts end with a line feed each
        points = np.frombuffer("".join(f"{_lowered(t)}\n" for t in texts).encode("utf-32-le"), np.uint32)
        points = np.where(points < _TOP, points, np.uint32(0))
        self.at = np.flatnonzero(part[points])         # places of all letters
        self.points = points[self.at].astype(np.uint64)
        kind = script[points[self.at]]
        n = len(self.at)
        start = np.ones(n, bool)
        if n:
            near = np.diff(self.at) == 1
            start[1:] = ~near | ((kind[1:] != kind[:-1]) & (kind[1:] != ANY) & (kind[:-1] != ANY))
            run = np.maximum.accumulate(np.where(start, np.arange(n), 0))
            start |= (np.arange(n) - run) % WORD == 0
        self.start = start
        self.first = np.flatnonzero(start)             # each word's first letter
        self.size = np.diff(np.append(self.first, n))
        self.script = np.where(kind[self.first] == ANY, COMMON, kind[self.first])
        self.text = np.searchsorted(self.offsets, self.at[self.first], side="right") - 1

    def blocks(self) -> Iterator[tuple[int, int, int, int]]:
        """(first word, last word + 1, first letter, last letter + 1) of blocks of about BLOCK letters."""
        a = 0
        while a < len(self.first):
            b = max(a + 1, int(np.searchsorted(self.first, self.first[a] + BLOCK)))
            b = min(b, len(self.first))
            yield a, b, int(self.first[a]), int(self.first[b]) if b < len(self.first) else len(self.at)
            a = b

    def grams(self, lo: int, hi: int, buckets: int) -> Iterator[np.ndarray]:
        """Per order the buckets of the n-grams that end at each of some letters; before a word are zeros."""
        points, start = self.points[lo:hi], self.start[lo:hi]
        shift = np.uint64(64 - (buckets.bit_length() - 1))
        back, inside = points, np.ones(hi - lo, bool)
        total = np.zeros(hi - lo, np.uint64)
        for n in range(ORDERS):
            total = total + (back + np.uint64(n + 1)) * _FACTORS[n]
            yield ((total ^ (total >> np.uint64(29))) * _FINAL >> shift).astype(np.int64)
            # One letter further back, as long as the word reaches.
            begins = start if n == 0 else np.concatenate((np.ones(min(n, hi - lo), bool), start[:-n] if n < hi - lo else start[:0]))
            inside = inside & ~begins
            back = np.where(inside, np.concatenate((np.zeros(min(n + 1, hi - lo), np.uint64), points[:-(n + 1)])), np.uint64(0))


class Model:
    """Names (sorted), log likelihoods by bucket and language, and the languages that use each script."""

    def __init__(self, names: list[str], likely: np.ndarray, candidates: np.ndarray):
        self.names, self.likely, self.candidates = names, likely, candidates

    def scores(self, words: Words) -> np.ndarray:
        """Each word's score for each language."""
        out = np.zeros((len(words.first), len(self.names)), np.float32)
        for a, b, lo, hi in words.blocks():
            letters = np.zeros((hi - lo, len(self.names)), np.float32)
            for order, bucket in enumerate(words.grams(lo, hi, self.likely.shape[1])):
                letters += self.likely[order][bucket]
            out[a:b] = np.add.reduceat(letters, words.first[a:b] - lo, axis=0)
        out -= out.max(1, keepdims=True, initial=-np.inf) if len(out) else 0
        np.maximum(out, -CLIP, out=out)
        out[~self.candidates[words.script]] = -FLOOR
        return out


def buckets_for(languages: int) -> int:
    return min(MAX_BUCKETS, 1 << max(1, (MODEL_CELLS // (ORDERS * max(1, languages))).bit_length() - 1))


# ---------------------------------------------------------------- learning

def _counts(batches: Iterator[pa.RecordBatch], languages: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """(language, text): sums by language and cell; cells above those of the n-grams count letters by script."""
    cells = ORDERS * buckets
    width = cells + 256
    total = np.zeros(languages * width, np.int64)
    for batch in batches:
        language = batch.column(0).to_numpy()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for lo, hi in _slices([len(t) for t in texts], BLOCK):
            words = Words(texts[lo:hi])
            of_word = language[lo:hi][words.text].astype(np.int64)
            for a, b, x, y in words.blocks():
                row = np.repeat(of_word[a:b] * width, words.size[a:b])
                for order, bucket in enumerate(words.grams(x, y, buckets)):
                    total += np.bincount(row + (order * buckets + bucket), minlength=len(total))
                np.add.at(total, of_word[a:b] * width + cells + words.script[a:b], words.size[a:b])
    total = total.reshape(languages, width)
    row, cell = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(cell, pa.int64()), pa.array(total[row, cell], pa.int64())],
                                     names=["language", "cell", "n"])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_per_language: int = MAX_PER_LANGUAGE) -> Model:
    """A model of the texts with a label; expects at most ``max_per_language`` texts of each, chosen by a hash."""
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    rows = docs.where(lang.isNotNull()).select(lang.alias("_lang"), text.alias("_text"), _order(docs).alias("_order"))
    sizes = {r[0]: r[1] for r in rows.groupBy("_lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(sizes)
    if not names:
        return Model([], np.zeros((ORDERS, 2, 0), np.float32), np.zeros((256, 0), bool))
    number = F.create_map(*[x for k, v in enumerate(names) for x in (F.lit(v), F.lit(k))])
    below = F.create_map(*[x for v in names for x in (F.lit(v), F.lit(min(1.0, max_per_language / sizes[v])))])
    chosen = rows.where(F.col("_order") < below[F.col("_lang")]).select(number[F.col("_lang")].cast("long").alias("_lang"), "_text")
    buckets, languages = buckets_for(len(names)), len(names)
    made = chosen.mapInArrow(lambda it: _counts(it, languages, buckets), "language long, cell long, n long")
    # At most MODEL_CELLS and a few rows, whatever the input.
    table = written(docs.sparkSession, made.groupBy("language", "cell").agg(F.sum("n").alias("n")), "languages").toPandas()
    total = np.zeros((languages, ORDERS * buckets + 256), np.float64)
    total[table["language"], table["cell"]] = table["n"]
    grams = total[:, :ORDERS * buckets].reshape(languages, ORDERS, buckets)
    likely = np.log((grams + SMOOTHING) / (grams.sum(2, keepdims=True) + SMOOTHING * buckets)) / ORDERS
    letters = total[:, ORDERS * buckets:]
    used = letters > CANDIDATE_SHARE * letters.sum(1, keepdims=True)
    used[:, ~used.any(0)] = True
    return Model(names, np.ascontiguousarray(likely.transpose(1, 2, 0)).astype(np.float32), np.ascontiguousarray(used.T))


def _order(docs: DataFrame) -> Column:
    """A number from 0 to 1 from the row's values."""
    flat = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.dataType.simpleString() in ("bigint", "int", "string")]
    return F.pmod(F.xxhash64(*flat), F.lit(1 << 30)) / float(1 << 30)


# ---------------------------------------------------------------- labelling

def viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray, switch: float) -> np.ndarray:
    """The language of each word; text i has the words first[i] to first[i] + count[i] - 1 of ``scores``."""
    label = np.zeros(len(scores), np.int16)
    if not scores.size:
        return label
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    active = np.searchsorted(-count, -np.arange(int(count[0]) if len(count) else 0), side="left")  # texts with a t-th word
    back = np.full(scores.shape, -1, np.int16)  # the language before, where it changes
    now = np.zeros((len(first), scores.shape[1]), np.float32)
    for t, m in enumerate(active.tolist()):
        word = first[:m] + t
        if t:
            best = now[:m].argmax(1)
            change = now[np.arange(m), best] - np.float32(switch)
            moved = now[:m] < change[:, None]
            if moved.any():
                back[word] = np.where(moved, best[:, None], -1)
                now[:m] = np.where(moved, change[:, None], now[:m])
        now[:m] += scores[word]
        now[:m] -= now[:m].max(1, keepdims=True)
    at = now.argmax(1).astype(np.int16)
    for t in range(len(active) - 1, -1, -1):
        m = int(active[t])
        word = first[:m] + t
        label[word] = at[:m]
        came = back[word, at[:m]]
        at[:m] = np.where(came >= 0, came, at[:m])
    return label


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    lo = total = 0
    for k, n in enumerate(sizes):
        if k > lo and total + n > most:
            yield lo, k
            lo, total = k, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def _labelled(texts: list[str], model: Model, switch: float) -> Iterator[tuple[int, Words, np.ndarray]]:
    """(first text, words, labels) of slices of texts."""
    for lo, hi in _slices([4 * len(t) for t in texts], BATCH_CELLS // max(1, len(model.names))):
        words = Words(texts[lo:hi])
        first = np.searchsorted(words.text, np.arange(hi - lo))
        count = np.searchsorted(words.text, np.arange(hi - lo), side="right") - first
        yield lo, words, viterbi(model.scores(words), first, count, switch)


def _predicted(batches: Iterator[pa.RecordBatch], model, switch: float, names: list[str]) -> Iterator[pa.RecordBatch]:
    model = model.value
    languages = len(model.names)
    for batch in batches:
        texts = [t or "" for t in batch.column(0).to_pylist()]
        letters = np.zeros((len(texts), max(1, languages)), np.int64)
        if languages:
            for lo, words, label in _labelled(texts, model, switch):
                np.add.at(letters, (lo + words.text, label), words.size)
        total = letters.sum(1)
        best = letters.argmax(1)
        share = letters[np.arange(len(texts)), best] / np.maximum(total, 1)
        lang = [model.names[k] if n else UNDETERMINED for k, n in zip(best.tolist(), total.tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(lang, pa.string()), pa.array(share)], names=names)


def _span_rows(batches: Iterator[pa.RecordBatch], model, switch: float) -> Iterator[pa.RecordBatch]:
    model = model.value
    for batch in batches:
        ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
        for lo, words, label in _labelled(texts, model, switch) if model.names else ():
            edge = np.ones(len(label), bool)
            edge[1:] = (words.text[1:] != words.text[:-1]) | (label[1:] != label[:-1])
            a = np.flatnonzero(edge)
            z = np.append(a[1:], len(label)) - 1
            base = words.offsets[words.text[a]]
            end = words.at[words.first[z] + words.size[z] - 1] + 1
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(lo + words.text[a])), pa.array(words.at[words.first[a]] - base, pa.int64()),
                 pa.array(end - base, pa.int64()), pa.array([model.names[k] for k in label[a].tolist()], pa.string())],
                names=["doc_id", "start", "end", "lang"])


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """doc_id, start, end (code points, without the end) and lang of each span."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _span_rows(it, held, switch), "doc_id long, start long, end long, lang string")


def predict(docs: DataFrame, model: Model, keep: list[Column], text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """The ``keep`` columns of each row with lang_pred and score; only the text is looked at."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep)
    names = [*kept.columns, "lang_pred", "score"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), "lang_pred string", "score double"])
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), *keep)
    return rows.mapInArrow(lambda it: _predicted(it, held, switch, names), schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def predictions(docs: DataFrame, switch: float = SWITCH) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred and score, by a model of the documents that are not held out."""
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return predict(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out")], switch=switch)
