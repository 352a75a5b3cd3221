"""The corpus pipeline: quality rules, quality classifier, near-duplicates, decontamination, tokens.

Each stage takes (spark, docs, sf_dir), works on every row of its input and returns a DataFrame that
is written as Parquet and read again as the next stage's ``docs``.  All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from telemark.llm import bpe, classifier, contamination, nearcopies, rules, simhash
from telemark.llm.queries import may_learn
from telemark.llm.shared import durable, table, unused


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    learned = rules.learn(docs, table(spark, sf_dir, "labels"))
    return rules.passed(docs, learned)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.5 or more."""
    model = classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), may_learn(F.col("doc_id")))
    score = unused(docs, "score")
    return classifier.score(docs, model, tuple(docs.columns), score).where(F.col(score) >= 0.5).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that hangs together by Jaccard 0.8 or more of five-word shingles."""
    return simhash.representatives(docs, nearcopies.near_copies).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document: their number, and digests of the ids and of the text decoded from them."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), digest=True)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: Learned rules, a trained model and a BPE cannot be expressed in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
