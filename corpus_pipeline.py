"""A training-corpus pipeline over ``documents``: five stages, each on all rows the one before kept.

1. quality: documents that the factorisation machine rejects (score below its cut) go.
2. line_dedup: blocks of lines that an earlier document has too leave the later one's text.
3. ngram_join: of each class of near-duplicate documents the one with the smallest id stays.
4. decontamination: documents that contain a test item go.
5. sentencepiece: token ids of each text, and their number.

All stages but the last return the columns of their input.  Results for odd input are those
of the operators (their module docstrings): null texts count as empty; rows with a null id
are one document each stage decides on; rows that repeat an id share its decision; an empty
table stays empty; further columns are kept.  ``text`` as edited by stage 2 keeps
``n_chars`` in step where that column is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, fm_quality, line_dedup, ngram_join, sentencepiece_viterbi
from tillroll.llm.common import NULL_ID, column, fresh, mark_probable, ship_package, written
from tillroll.session import scratch_path



def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without those whose key is in ``ids``; only texts that may go are shuffled."""
    key, hit = fresh(docs.columns, "_key", "_hit")
    ids = written(docs.sparkSession, ids.select(F.col(ids.columns[0]).alias(key)).distinct(), "dropped")
    rows = mark_probable(docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))), ids, key, hit)
    kept = rows.where(column(hit)).join(ids, key, "left_anti")
    return rows.where(~column(hit)).unionByName(kept).select(*map(column, docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fm_quality.train(docs, _table(spark, sf_dir, "labels"))
    (score,) = fresh(docs.columns, "_score")
    scored = fm_quality.score(docs, model, score_col=score)
    return scored.where(column(score) >= fm_quality.CUT).drop(score)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = ngram_join.near_duplicates(docs).where("_id != _class").select("_id")
    return _without(docs, others)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"))
    return _without(docs, found.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id")))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.encode(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# A trained model's scores have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
