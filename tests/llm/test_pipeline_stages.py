"""The corpus pipeline, each stage against a plain version on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import fm_quality, line_dedup, sentencepiece_viterbi
from tillroll.session import checkpoint_root

from corpus_data import corpus, make, prose  # noqa: F401
from test_duplicates import plain_classes, plain_lines, plain_sets

SF = "/root/testdata/sf0.001"


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def stages(spark):
    """The input and output of every stage over the smallest fixture."""
    checkpoint_root(spark)
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).checkpoint()
        out.append((name, docs, after))
        docs = after
    return out


def test_names_and_columns(stages):
    assert [s[0] for s in stages] == ["quality", "line_dedup", "ngram_join", "decontamination", "sentencepiece"]
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns
    assert stages[-1][2].columns == [*stages[-1][1].columns, "token_ids", "n_tokens"]


def test_quality_drops_what_the_classifier_rejects(stages, spark):
    _, docs, after = stages[0]
    model = fm_quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in fm_quality.predictions(docs, model).where("predicted = 1").collect()}
    assert texts(after) == texts(docs.where(F.col("doc_id").isin(list(kept)))) and 0 < len(kept) < docs.count()


def test_line_dedup_edits_texts(stages):
    import hashlib
    _, docs, after = stages[1]
    want = plain_lines(texts(docs))
    got = {r.doc_id: (hashlib.sha256(r.text.encode()).hexdigest(), r.n_chars, len(r.text)) for r in after.collect()}
    assert {i: g[0] for i, g in got.items()} == {i: w[2] for i, w in want.items()}
    assert all(n == k for _, n, k in got.values()) and any(w[1] for w in want.values())


def test_one_document_of_each_class_stays(stages):
    _, docs, after = stages[2]
    classes = plain_classes(texts(docs))
    assert texts(after) == [x for x in texts(docs) if classes[x[0]][1] == x[0]]


def test_documents_with_test_items_go(stages, spark):
    _, docs, after = stages[3]
    items = plain_sets([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]).values()
    sets = plain_sets(texts(docs))
    leaks = {i for i, s in sets.items() if any(x and 100 * len(x & s) >= 75 * len(x) for x in items)}
    assert texts(after) == [x for x in texts(docs) if x[0] not in leaks]


def test_token_ids_equal_the_library(stages):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_viterbi.DEFAULT_MODEL)
    _, docs, after = stages[4]
    assert after.count() == docs.count()
    assert all(r.token_ids == lib.encode(r.text) and r.n_tokens == len(r.token_ids) for r in after.collect())


def test_run_equals_the_stages(stages, spark):
    assert texts(corpus_pipeline.run(spark, SF)) == texts(stages[-1][2])


def test_stages_on_odd_tables(make, spark, corpus):
    checkpoint_root(spark)
    for rows in (corpus, []):
        docs = make(rows).limit(len(rows))
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SF).checkpoint()
            assert after.columns[:len(docs.columns)] == docs.columns
            assert after.count() <= docs.count() and (rows or after.count() == 0)
            docs = after


def test_lines_that_repeat_are_gone(make):
    line = "this line has more than ten words so that it is a block of its own"
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(make([(1, "a\n" + line), (2, line + "\nb"), (3, line)])).collect()}
    assert out == {1: "a\n" + line, 2: "b", 3: ""}
