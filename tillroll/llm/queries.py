"""The registered queries of this subpackage: one ``opN_<name>`` per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (conversation_repair, decontaminate, fm_quality, hard_negatives, language_id, line_dedup, ngram_join,
                          secret_scan, sentencepiece_viterbi, suffix_dedup)
from tillroll.llm.common import ship_package
from tillroll.llm.fingerprint import edit_likeness
from tillroll.llm.token_counts import token_counts
from tillroll.llm.warc import pages_round_trip


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_round_trip(_read(spark, sf_dir, "pages"))


def op2_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return fm_quality.predictions(docs, fm_quality.train(docs, _read(spark, sf_dir, "labels")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, words = _read(spark, sf_dir, "documents"), secret_scan.dictionary(spark)
    return secret_scan.scan(docs, words, secret_scan.planted_findings(docs, words))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.round_trip(_read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_read(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_report(_read(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(_read(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(_read(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(_read(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_report(_read(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_fm_quality": op2_fm_quality,
    "op3_token_counts": op3_token_counts,
    "op4_secret_scan": op4_secret_scan,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_line_dedup": op6_line_dedup,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_decontaminate": op9_decontaminate,
    "op10_fingerprints": op10_fingerprints,
    "op11_language_id": op11_language_id,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op9_decontaminate": decontaminate.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
