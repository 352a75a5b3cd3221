"""Hard negatives against all inner products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemark.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor=lambda v: v % 100 == 0):
    """Ids, labels and vectors by the rule; a missing component counts as zero."""
    taking = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        taking.append((vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = []
    for anchor_id, label, vector in {t for t in taking if t[0] is not None and is_anchor(t[0])}:
        scored = [(sum(a * b for a, b in zip(vector, v)), math.inf if i is None else i, other == label) for i, other, v in taking if i != anchor_id]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for ps, positive, _ in [s for s in scored if s[2]][:5]:
            fitting = [s for s in scored if not s[2] and 80 * ps <= 100 * s[0] <= 100 * ps][:5]
            out += [(anchor_id, positive, k + 1, i, ps, s) for k, (s, i, _) in enumerate(fitting)]
    return sorted((tuple(None if x == math.inf else x for x in r) for r in out), key=repr)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("norm", "vector", "query", "rank", "score")})
    return sorted((tuple(r) for r in negatives.mine(df, **options).collect()), key=repr)


def vectors(seed, n, width, scale=1.0):
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, width)) * scale * r.uniform(0.2, 2, (n, 1))).astype(np.float32).tolist()


@pytest.fixture(scope="module")
def rows():
    out = [(k, v, k % 4) for k, v in enumerate(vectors(1, 901, 6))]
    # one vector shared by many rows of several labels, so that ties decide
    out += [(1000 + k, out[3][1], k % 3) for k in range(120)]
    out += [(2000, [0.0] * 6, 1), (2001, [], 2), (2100, [1.0, 2.0], 1), (2101, [9e30] * 6, 1)]
    out += [(2200, None, 1), (2201, [1.0] * 6, None), (2202, [float("nan")] * 6, 1), (2203, [float("inf"), 1.0], 1), (2204, [None, 1.0], 1)]
    out += [(None, out[5][1], 1), (None, out[200][1], 2), (100, out[100][1], 0), (300, out[300][1], 0), (301, out[301][1], 1)]
    return out


def test_all_rows(spark, rows):
    sound = [r for r in rows if r[0] != 2101]  # too long for whole-numbered scores of 64 bits: takes no part
    want = brute(sound)
    assert len(want) > 100 and mined(spark, rows) == want


def test_anchors_in_blocks_and_small_buckets(spark, rows, monkeypatch):
    sound = [r for r in rows if r[0] != 2101]
    monkeypatch.setattr(negatives, "BLOCK", 50)
    assert mined(spark, rows, anchors_at_once=3) == brute(sound)


def test_large_components(spark):
    rows = [(k * 10, [x * 3000 for x in v], k % 3) for k, v in enumerate(vectors(2, 200, 5))]
    assert mined(spark, rows) == brute(rows)


def test_nothing(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == [] and mined(spark, [(100, [1.0], 1)]) == []


def test_pruning_loses_nothing_and_prunes():
    """Every row that reaches the bar is a candidate; with a high bar few others are."""
    r = np.random.default_rng(3)
    centre = r.normal(size=(20, 8))
    base = np.rint(256 * (centre[r.integers(0, 20, 2000)] + 0.2 * r.normal(size=(2000, 8)))).astype(np.int64)
    bucket = negatives.Bucket(base)
    anchors = base[:40]
    norms = np.sqrt((anchors.astype(float) ** 2).sum(1))
    scores = anchors @ base.T
    for share in (0.5, 0.8, 0.95):
        least = share * scores.max(1)
        alive, marks = bucket.candidates(anchors / norms[:, None], norms, least)
        full = np.zeros(scores.shape, bool)
        full[alive] = marks
        assert not ((scores >= least[:, None]) & ~full).any()
    assert full.mean() < 0.5
