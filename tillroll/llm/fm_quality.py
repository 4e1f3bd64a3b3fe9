"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

    score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

with vectors v_i of RANK numbers.  The pairwise part is never formed pair by pair:
it is 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), linear in a text's words.

Features: counts of the words hashed to WORDS buckets, scaled to unit length; structure
statistics of the whole text (shares of kinds of characters, word lengths, repetition),
and its length as metadata, each standardised.  Labels, language, source and id are never
inputs.

Training: on at most ``max_labelled`` labelled texts, those with the smallest hashes of
their ids among the rows of the training folds (crc32 of the id as text, modulo 5, not 0).
They are dealt to SHARDS groups; in each of ROUNDS rounds every group goes on from the
common model by Adagrad steps and the models are averaged.  The model (under 1 MB) is the
only thing that goes through the driver.

Results for odd input: a null text counts as empty, and an empty one has a score as any
other; a null id is held out if crc32 of the empty text says so; repeated rows are scored
each; a label that is null, or of no document, is not used, and of repeated labels of one id
the largest counts; without labelled rows every score is the one of an untrained model,
0.5; an empty table gives no rows.  Further columns do not matter.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import positional, text_chunks, word_hashes, written

WORDS = 1 << 14
RANK = 6
MAX_LABELLED = 16_000
SHARDS, ROUNDS, EPOCHS, BATCH = 4, 3, 3, 64
CUT = 0.3
# Fixed groups of characters whose shares describe a text's structure.
_GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b"!", b"?", b".", b",;:", b"#$%&*+~^<>@_", b"|",
           b"\"'()[]{}=/\\-"]
STATISTICS = len(_GROUPS) + 10


def _shares(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


_IN_GROUP = np.zeros((len(_GROUPS), 256), bool)
for _k, _g in enumerate(_GROUPS):
    _IN_GROUP[_k, list(_g)] = True


def features(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray):
    """Of adjoining texts: document and bucket of each word feature, its value, and the statistics."""
    n = len(offsets) - 1
    words, doc = word_hashes(data, offsets)
    per = np.bincount(doc, minlength=n).astype(float)
    key = doc * WORDS + (words >> np.uint64(50)).astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    where, bucket = key // WORDS, key % WORDS
    norm = np.sqrt(np.bincount(where, weights=count.astype(float) ** 2, minlength=n))
    value = count / norm[where]
    size = np.diff(offsets).astype(float)
    some = np.maximum(per, 1)
    spaces = _shares(_IN_GROUP[2][data] | _IN_GROUP[3][data], offsets)
    again = np.bincount(doc[1:][(words[1:] == words[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, where, count)
    distinct = np.bincount(where, minlength=n)
    stats = [_shares(g[data], offsets) for g in _IN_GROUP]
    stats += [_shares(data >= 128, offsets), np.log1p(size), np.log1p(per), size * (1 - spaces) / some, distinct / some,
              top / some, again / some, np.log1p(n_chars), (size == 0).astype(float),
              np.log1p(distinct) / np.log1p(some)]
    return where, bucket, value, np.stack(stats, 1)


class Model:
    """Weights ``w`` and vectors ``v`` of the words, then the statistics; their mean and scale."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        size = WORDS + STATISTICS
        self.w0, self.w = np.zeros(1), np.zeros(size)
        self.v = rng.normal(0, 0.05, (size, RANK))
        self.mean, self.scale = mean, scale

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, w0=self.w0, w=self.w.astype(np.float32), v=self.v.astype(np.float32), mean=self.mean, scale=self.scale)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Model:
        model = cls.__new__(cls)
        for k, a in np.load(io.BytesIO(data)).items():
            setattr(model, k, a.astype(float))
        return model

    def standard(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -6, 6)

    def raw(self, where, bucket, value, stats):
        """Sums before the sigmoid and the inner sums of the pairwise part."""
        n = len(stats)
        z = self.standard(stats)
        out = self.w0 + np.bincount(where, weights=value * self.w[bucket], minlength=n) + z @ self.w[WORDS:]
        s = z @ self.v[WORDS:]
        q = (z * z) @ (self.v[WORDS:] ** 2)
        for f in range(RANK):
            part = value * self.v[bucket, f]
            s[:, f] += np.bincount(where, weights=part, minlength=n)
            q[:, f] += np.bincount(where, weights=part * part, minlength=n)
        return out + 0.5 * (s * s - q).sum(1), s, z

    def scores(self, *features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*features)[0], -40, 40)))


def fit(model: Model, where, bucket, value, stats, labels, epochs: int, seed: int, rate=0.05, decay=1e-4) -> None:
    """Adagrad steps on the log loss, in place."""
    rng = np.random.default_rng(seed)
    edges = np.searchsorted(where, np.arange(len(stats) + 1))
    gw, gv, g0 = np.full(len(model.w), 1e-2), np.full(model.v.shape, 1e-2), 1e-2
    size = len(model.w)
    for _ in range(epochs):
        order = rng.permutation(len(stats))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            span = np.concatenate([np.arange(edges[r], edges[r + 1]) for r in rows])
            doc = np.repeat(np.arange(len(rows)), edges[rows + 1] - edges[rows])
            b, x = bucket[span], value[span]
            raw, s, z = model.raw(doc, b, x, stats[rows])
            err = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[rows]) / len(rows)
            col = np.concatenate([b, np.tile(np.arange(WORDS, size), len(rows))])
            of = np.concatenate([doc, np.repeat(np.arange(len(rows)), STATISTICS)])
            xs = np.concatenate([x, z.ravel()])
            e = err[of] * xs
            seen = np.unique(col)
            grad = np.bincount(col, weights=e, minlength=size)[seen] + decay * model.w[seen]
            gw[seen] += grad ** 2
            model.w[seen] -= rate * grad / np.sqrt(gw[seen])
            ex = np.bincount(col, weights=e * xs, minlength=size)[seen]
            for f in range(RANK):
                old = model.v[seen, f]
                grad = np.bincount(col, weights=e * s[of, f], minlength=size)[seen] - ex * old + decay * old
                gv[seen, f] += grad ** 2
                model.v[seen, f] = old - rate * grad / np.sqrt(gv[seen, f])
            g0 += err.sum() ** 2
            model.w0 -= rate * err.sum() / np.sqrt(g0)


# ------------------------------------------------------------------------- Spark


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, label, text, n_chars) as feature rows."""
    for b in batches:
        for at, data, offsets in text_chunks(b.column(2)):
            k = len(offsets) - 1
            where, bucket, value, stats = features(data, offsets, b.column(3).slice(at, k).to_numpy(zero_copy_only=False))
            ends = pa.array(np.searchsorted(where, np.arange(k + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([
                b.column(0).slice(at, k), b.column(1).slice(at, k),
                pa.ListArray.from_arrays(ends, pa.array(bucket, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(value)),
                pa.ListArray.from_arrays(pa.array(np.arange(0, (k + 1) * STATISTICS, STATISTICS), pa.int32()),
                                         pa.array(stats.ravel())),
            ], names=["key", "label", "bucket", "value", "stats"])


_FEATURES = "key long, label double, bucket array<int>, value array<double>, stats array<double>"


def _inputs(docs: DataFrame, id_col: str, text_col: str, chars_col: str | None):
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    length = F.char_length(text).cast("double")
    if chars_col and chars_col in docs.columns:
        length = F.coalesce(F.col(chars_col).cast("double"), length)
    return F.col(id_col).cast("long"), text.alias("text"), F.greatest(length, F.lit(0.0)).alias("n_chars")


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _step(state, seed: int):
    """Goes on from the model in ``state`` on one shard."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        model = Model.load(state.value)
        pdf = pdf.sort_values(["key"], kind="stable")
        where = np.repeat(np.arange(len(pdf)), pdf["bucket"].map(len))
        fit(model, where, np.concatenate(pdf["bucket"].to_list()).astype(np.int64), np.concatenate(pdf["value"].to_list()),
            np.stack(pdf["stats"].to_list()), pdf["label"].to_numpy(float), EPOCHS, seed)
        return pd.DataFrame({"model": [model.dump()], "rows": [len(pdf)]})
    return run


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id",
          text_col: str = "text", chars_col: str | None = "n_chars", label_col: str = "quality") -> Model:
    """A model of the labelled rows of the training folds."""
    spark = docs.sparkSession
    sample = (labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("double").alias("_label"))
              .where(F.col("_label").isNotNull() & F.col("_id").isNotNull()).where(~held_out(F.col("_id")))
              .groupBy("_id").agg((F.max("_label") > 0).cast("double").alias("_label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    sample = written(spark, sample, "labels")
    key, text, n_chars = _inputs(docs, id_col, text_col, chars_col)
    rows = docs.select(key.alias("key"), text, n_chars).join(F.broadcast(sample), F.col("key") == F.col("_id"))
    rows = written(spark, rows.select("key", F.col("_label").alias("label"), "text", "n_chars").mapInArrow(_rows, _FEATURES),
                   "features")
    moments = rows.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(
        F.mean("x").alias("m"), F.stddev_pop("x").alias("s")).orderBy("i").collect()
    if not moments:
        model = Model(np.zeros(STATISTICS), np.ones(STATISTICS))
        model.v[:] = 0
        return model
    model = Model(np.array([r.m for r in moments]), np.array([max(r.s, 1e-6) for r in moments]))
    shards = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(SHARDS))).groupBy("shard")
    for k in range(ROUNDS):
        step = _step(spark.sparkContext.broadcast(model.dump()), k)
        parts = shards.applyInPandas(step, "model binary, rows long").collect()  # SHARDS models
        total = sum(r.rows for r in parts)
        models = [(r.rows / total, Model.load(bytes(r.model))) for r in sorted(parts, key=lambda r: (r.rows, bytes(r.model)))]
        for name in ("w0", "w", "v"):
            setattr(model, name, sum(share * getattr(m, name) for share, m in models))
    return model


def _scored(batches: Iterator[pa.RecordBatch], state, text: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    model = Model.load(state.value)
    for b in batches:
        scores = [np.zeros(0)]
        chars = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
        for at, data, offsets in text_chunks(b.column(text)):
            scores.append(model.scores(*features(data, offsets, chars[at:at + len(offsets) - 1])))
        yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(np.concatenate(scores))], names=names)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          chars_col: str | None = "n_chars", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text (in place of a column of that name)."""
    state = docs.sparkSession.sparkContext.broadcast(model.dump())
    docs = docs.drop(score_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    _, text, n_chars = _inputs(docs, id_col, text_col, chars_col)
    rows = positional(docs.select("*", text.alias("_fm_text"), n_chars.alias("_fm_chars")))
    at, names = len(docs.columns), schema.names
    return rows.mapInArrow(lambda it: _scored(it, state, at, names), schema)


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[c for c in ("n_chars",) if c in docs.columns])
    return score(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= CUT).cast("int").alias("predicted"))
