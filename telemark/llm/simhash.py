"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link when at most two bits differ.  The anchors are the words of the perfect
Hamming code of length 63 (covering radius 1), taken with either value of the last bit.  If two
fingerprints differ in two bits or fewer, some point lies within one bit of both, and the anchor
nearest to that point lies within covering radius plus that one bit of both.  So every distinct
fingerprint is copied to the at most 33 anchors there (31 pairs of flips, the nearest anchor, and
the nearest anchor with the last bit turned), and fingerprints are compared per anchor.  An anchor
can meet at most 4,034 distinct fingerprints, whatever the data, so no group is ever hot; equal
fingerprints collapse before, and groups with one member cost one comparison of neighbours.

Links become components by alternating star steps, each written to shared storage.  Tables per
document (id, fingerprint) are joined on the fingerprint; the skew of large groups of copies is left
to the adaptive join, which splits the document side.

Edge cases: a null text counts as empty; texts without words have fingerprint zero and link like any
other; rows with null ids take part, and ``component_id`` is the smallest id that is not null (null
if there is none); repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from telemark.llm.shared import durable, unused

SHINGLE = 3
HASH_SEED = 42
BLOCK = 1 << 16


def fingerprint(text: bytes | None) -> int:
    """Majority bits over the hashes of all shingles, repeats included; memory is bounded by blocks."""
    words = (text or b"").lower().split()  # on bytes both touch ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], stops[: -SHINGLE] + 1)).tolist()
    last = stops[SHINGLE - 1 :].tolist()
    total = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), BLOCK):
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(first[at : at + BLOCK], last[at : at + BLOCK])], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * total > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        values = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
        others = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), pa.array(values)], [*others, "fingerprint"])


#: _FLIPS[s] has the pairs of positions whose exclusive or is s, as bit masks (position p is bit p - 1).
def _flips() -> np.ndarray:
    out = np.zeros((64, 31), np.uint64)
    for s in range(1, 64):
        pairs = [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 64) if i != s and i < i ^ s]
        out[s] = np.array(pairs, np.uint64)
    return out


def anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of all anchors to which fingerprints are copied."""
    values = values.view(np.uint64)
    masks = [sum(1 << (p - 1) for p in range(1, 64) if p >> k & 1) for k in range(6)]
    syndrome = sum((np.bitwise_count(values & np.uint64(m)).astype(np.int64) & 1) << k for k, m in enumerate(masks))
    flip = np.where(syndrome > 0, np.uint64(1) << np.maximum(syndrome - 1, 0).astype(np.uint64), np.uint64(0))
    nearest = values ^ flip
    rows = np.arange(len(values))
    off = np.flatnonzero(syndrome)  # a word of the code is its own and only anchor
    further = values[off, None] ^ _flips()[syndrome[off]]
    return (
        np.concatenate([rows, rows, np.repeat(off, 31)]),
        np.concatenate([nearest, nearest ^ np.uint64(1 << 63), further.ravel()]).view(np.int64),
    )


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("fingerprint").to_numpy(zero_copy_only=False)
        for at in range(0, len(values), 4096):
            part = values[at : at + 4096]
            row, anchor = anchors(part)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[row])], ["anchor", "fingerprint"])


def forest(values: np.ndarray, bits: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all of ``values`` (one anchor's fingerprints) that hang together, one per further member."""
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= bits
    label = np.arange(len(values), dtype=np.int32)
    while True:
        low = np.where(close, label[None, :], np.int32(len(values))).min(1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each anchor; rows come sorted by anchor, and an anchor's rows may span batches."""
    held = (np.empty(0, np.int64), np.empty(0, np.uint64))

    def links(anchor: np.ndarray, value: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(anchor) else np.empty(0, np.int64)
        sizes = np.diff(np.concatenate((starts, [len(anchor)])))
        twos = starts[sizes == 2]
        near = twos[np.bitwise_count(value[twos] ^ value[twos + 1]) <= 2]
        left, right = [value[near]], [value[near + 1]]
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            a, b = forest(value[start : start + size])
            left.append(a)
            right.append(b)
        return left, right

    def rows(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
        a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

    for batch in batches:
        anchor = np.concatenate((held[0], batch.column("anchor").to_numpy(zero_copy_only=False)))
        value = np.concatenate((held[1], batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)))
        if not len(anchor):
            continue
        cut = int(np.searchsorted(anchor, anchor[-1], side="left"))
        held = (anchor[cut:], value[cut:])
        yield rows(*links(anchor[:cut], value[:cut]))
    yield rows(*links(*held))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is a component's smallest node.

    Alternating large and small star steps: the number of rounds grows with the logarithm of the
    longest chain, and each round is one table in shared storage.
    """
    links = durable(links.where("a > b").distinct(), "links")
    seen = None
    while True:
        mark = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            break
        seen = mark
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = links.select(F.col("b").alias("a"), F.col("a").alias("b")).join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        small = small.where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.withColumnRenamed("low", "b"))
        links = durable(small.distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def groups(distinct: DataFrame) -> DataFrame:
    """Rows of ``distinct`` (each ``fingerprint`` once) with ``group``, a fingerprint that names the component of links."""
    copies = distinct.select("fingerprint").mapInArrow(_copies, "anchor long, fingerprint long")
    links = copies.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare, "a long, b long")
    roots = components(links)
    named = distinct.join(roots, distinct.fingerprint == roots.node, "left")
    return named.withColumn("group", F.coalesce("root", "fingerprint")).drop("node", "root")


def near_duplicates(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``extra`` columns, fingerprint (long), group (a fingerprint that names the component) and component_id."""
    prints = durable(
        docs.select("doc_id", *extra, "text").mapInArrow(
            _fingerprints,
            ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", *extra)) + ", fingerprint long",
        ),
        "fingerprints",
    )
    distinct = durable(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct")
    named = durable(groups(distinct).select("fingerprint", "first_id", "group"), "groups")
    smallest = named.groupBy("group").agg(F.min("first_id").alias("component_id"))
    classes = named.select("fingerprint", "group").join(smallest, "group")
    return prints.join(classes, "fingerprint", "left")


def representatives(docs: DataFrame, search: Callable[[DataFrame, tuple[str, ...]], DataFrame] = near_duplicates) -> DataFrame:
    """One row of ``docs`` for each component that ``search`` finds: that with the smallest id (null ids
    last; among rows of one id, the smallest hash of the text), whole and unchanged, columns of any name included."""
    mark = F.xxhash64("text")
    found = search(docs.select("doc_id", "text", mark.alias("_mark")), ("_mark",))
    keys = [unused(docs, stem) for stem in ("id", "null", "mark")]
    chosen = (
        found.groupBy("group")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_mark")).alias("best"))
        .select(F.coalesce("best.doc_id", F.lit(-1)).alias(keys[0]), F.col("best.n").alias(keys[1]), F.col("best._mark").alias(keys[2]))
    )
    keyed = docs.withColumns(dict(zip(keys, (F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), mark))))
    return keyed.join(chosen, keys, "left_semi").dropDuplicates(keys).drop(*keys)
