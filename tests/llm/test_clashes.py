"""Columns of the input that have the names the operators use themselves."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from telemark.llm import bpe, classifier, contamination, nearcopies, rules, simhash
from tests.llm.test_operators import prose

NAMES = ["n_words", "_q_words", "kept", "_key", "_key_0", "_row_0", "_mark", "_mark_0", "_id", "_null", "_score", "_score_0", "n_tokens", "ids", "group", "digest", "n", "held_out"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, prose(k % 9, 60)) for k in range(12)] + [(None, prose(3, 60)), (20, None), (21, "word after word " * 40)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in NAMES})


def whole(df, columns):
    return sorted((tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect()), key=repr)


def test_rows_pass_through_unchanged(spark, docs):
    every = {repr(r) for r in whole(docs, docs.columns)}
    items = spark.createDataFrame([(1, prose(4, 60))], "item_id long, text string")
    passed = rules.passed(docs, [])
    clean = contamination.clean(docs, items)
    single = simhash.representatives(docs, nearcopies.near_copies)
    for out in (passed, clean, single):
        assert out.columns == docs.columns
        assert {repr(r) for r in whole(out, docs.columns)} <= every
    assert passed.count() == docs.count() - 2  # the null text and the repeated words fail the base rules
    assert clean.count() == docs.count() - 1 and single.count() == 11


def test_results_take_the_place_of_columns_of_their_names(docs):
    judged = rules.judge(docs, [])
    assert [c for c in judged.columns if c == "n_words"] == ["n_words"] and judged.schema["n_words"].dataType.simpleString() == "bigint"
    encoded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=("doc_id", *NAMES), piece_chars=100)
    assert encoded.count() == docs.count() and encoded.columns.count("n_tokens") == 1
    assert whole(encoded, ["doc_id", "_key", "_key_0"]) == whole(docs, ["doc_id", "_key", "_key_0"])


def test_classifier_stage(spark, docs, tmp_path):
    docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = corpus_pipeline.quality_classifier(spark, docs, str(tmp_path))  # no labels: every score is 0.5
    assert kept.columns == docs.columns and whole(kept, docs.columns) == whole(docs, docs.columns)
    scored = classifier.score(docs, (classifier.np.zeros(classifier.BUCKETS), 0.0), tuple(docs.columns))
    assert scored.columns.count("_score") == 1
