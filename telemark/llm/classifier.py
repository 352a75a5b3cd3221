"""Quality classifier: supervised subword embeddings, averaged per document.

Every word stands for itself and for its character n-grams of 3 to 5 bytes, all hashed into a fixed
number of buckets with one learned vector each.  A document is the average of its feature vectors; a
softmax layer turns it into class probabilities.  Training is plain stochastic gradient descent in
numpy over a bounded sample of labelled documents; scoring runs in tasks with a broadcast table of
one number per bucket (the vectors enter the two-class softmax only through the difference of the
two outputs), so the broadcast has a fixed size.

Edge cases: null and empty texts have no features and get the score of the bias alone; null ids are
scored like others; repeated rows get equal scores; without labels every score is 0.5.  Only ``text``
is an input of a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 1 << 16
DIMENSIONS = 16
#: At most so many labelled documents are learned from, those with the smallest hash of their id.
SAMPLE_ROWS = 3_000
EPOCHS = 8
RATE = 0.5
SEED = 17
CACHED_WORDS = 200_000


def features(word: bytes) -> np.ndarray:
    """Buckets of the word and of its character n-grams with the word's edges marked."""
    marked = b"<" + word + b">"
    grams = [zlib.crc32(marked)]
    for n in (3, 4, 5):
        grams += [zlib.crc32(marked[i : i + n]) for i in range(len(marked) - n + 1)]
    return np.array(grams, np.int64) % BUCKETS


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of each text."""
    cache: dict[bytes, np.ndarray] = {}
    for batch in batches:
        out = []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            counts = np.zeros(BUCKETS, np.float32)
            for word in (text or b"").split():
                found = cache.get(word)
                if found is None:
                    found = features(word)
                    if len(word) <= 64:
                        if len(cache) >= CACHED_WORDS:
                            cache.clear()
                        cache[word] = found
                np.add.at(counts, found, 1)
            used = np.flatnonzero(counts)
            out.append((used.astype("<i4").tobytes(), counts[used].tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary())],
            ["doc_id", "label", "buckets", "counts"],
        )


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Fit on labelled documents; returns one logit per bucket and the bias.

    ``usable`` restricts the ids that may be learned from.  Contradicting labels of one id are left out.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    if usable is not None:
        ids = ids.where(usable)
    sample = (
        ids.groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("_high"))
        .where(F.col("label") == F.col("_high"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
        .select("doc_id", F.col("label").cast("int"))
    )
    bags = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = bags.mapInArrow(_bags, "doc_id long, label int, buckets binary, counts binary").orderBy(F.xxhash64("doc_id"), "doc_id", "buckets").limit(sample_rows).collect()
    return fit([(np.frombuffer(r.buckets, "<i4"), np.frombuffer(r.counts, np.float32), r.label) for r in rows])


def fit(bags: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent over bucket counts; reproducible for equal input."""
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    output, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    bags = [(ids, counts / counts.sum(), label) for ids, counts, label in bags if len(ids)]
    step, steps = 0, max(1, EPOCHS * len(bags))
    for _ in range(EPOCHS):
        for k in random.permutation(len(bags)):
            ids, weights, label = bags[k]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = weights @ vectors[ids]
            scores = hidden @ output + bias
            probabilities = np.exp(scores - scores.max())
            probabilities /= probabilities.sum()
            error = probabilities
            error[label] -= 1
            pull = output @ error
            output -= rate * np.outer(hidden, error)
            bias -= rate * error
            # the average is spread over many vectors: each moves by its share of the document, scaled up to be felt
            vectors[ids] -= (rate * len(ids) * weights)[:, None] * pull[None, :]
    difference = output[:, 1] - output[:, 0]
    return vectors @ difference, float(bias[1] - bias[0])


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: tuple[str, ...] = ("doc_id",), name: str = "_score") -> DataFrame:
    """``keep`` columns and the probability of label 1 as ``name``, which takes the place of a kept column of that name."""
    keep = tuple(c for c in keep if c.lower() != name.lower())
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((np.asarray(model[0], np.float64), model[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logits, bias = shared.value

        class Words(dict):
            """Sum of logits (real part) and number of features (imaginary part) of each word."""

            def __missing__(self, word: bytes) -> complex:
                found = features(word)
                value = complex(logits[found].sum(), len(found))
                if len(word) <= 64:
                    if len(self) >= CACHED_WORDS:
                        self.clear()
                    self[word] = value
                return value

        known = Words()
        for batch in batches:
            scores = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                total = sum(map(known.__getitem__, (text or b"").split()), 0j)
                scores.append(1 / (1 + np.exp(-np.clip(total.real / total.imag if total.imag else 0.0, -500, 500) - bias)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores, pa.float64())], [*keep, name])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{schema}, `{name}` double")
