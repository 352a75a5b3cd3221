"""Fill-in-middle against a plain reading of its rule."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from telemark.llm import infill


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    letters = "aé日🙂́ \n\x00<>PSM"
    out = [(k, "".join(r.choice(letters) for _ in range(r.randint(0, 60)))) for k in range(150)]
    out += [(200, None), (201, ""), (202, "has <P> inside"), (203, "🙂" * 700_000), (204, "x" * 2_500_001), (None, "no id"), (None, None), (7, out[7][1]), (7, "same id")]
    return out + [(k, out[2][1]) for k in range(300, 340)]


def test_transform_and_restore(spark, rows):
    # columns that the operator uses inside, with other contents, and a repeated row
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("n", "form", "first", "second", "h1", "output")})
    made = infill.transform(docs).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made), key=repr)
    assert got == sorted(((k, *brute(k, t)) for k, t in rows), key=repr)
    assert sorted((r.back for r in made)) == sorted(t or "" for _, t in rows)
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert infill.transform(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aé日🙂", max_size=30), max_size=6), st.integers(4, 40), st.randoms())
def test_parts_of_any_size(texts, part, r):
    first = np.array([r.randint(0, len(t)) for t in texts], np.int64)
    second = np.array([r.randint(int(a), len(t)) for a, t in zip(first, texts)], np.int64)
    found = infill.pieces([memoryview(t.encode()) for t in texts], first, second, part)
    want = {"prefix": [t[:a] for t, a in zip(texts, first)], "middle": [t[a:b] for t, a, b in zip(texts, first, second)], "suffix": [t[b:] for t, b in zip(texts, second)]}
    for role, column in found.items():
        assert [x.decode() for x in pa.array(column).to_pylist()] == want[role]
