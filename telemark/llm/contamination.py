"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by their number of shingles into classes of a factor of two.  For a class
of at most ``u`` shingles a document is seen as windows of ``2u`` shingles, one every ``u``, so any
run of ``u`` shingles lies whole in a window and a contained item has a Jaccard similarity of at
least 0.19 with it.  Each of 64 bands is one minimum, so a window that holds 80 percent of an item
collides in some band with probability 1 - 1e-6 or more.  Items of fewer than ``FEW`` shingles would be
too small a part of the smallest windows: any one of their shingles proposes them.  A collision only
proposes a pair; whether it counts is decided by exact containment of the item's distinct shingles in the whole document.

The test items are a stated query set: they are taken in blocks of bounded size, and each block is
broadcast to one pass over all documents.  Documents are never shuffled, so hot sources, copies and
passages that many documents share cost nothing extra.

Words are runs of letters and digits in lower case.  Edge cases: null and empty texts hold nothing;
items with fewer than five words have no shingle and are never reported; null ids are reported as
null; repeated documents or items give repeated pairs; with no items the result is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from telemark.llm.shared import unused

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64
SMALLEST_CLASS = 16
#: Items of fewer shingles are looked up by every shingle.
FEW = 4
#: Characters of test items that are broadcast at once.
BLOCK_CHARS = 2_000_000
CACHED_WORDS = 200_000
PART = 8192  # windows are built from parts of so many shingles, or the largest class if that is more

_WORD = re.compile(r"[^\W_]+")
_ODD = np.random.default_rng(5).integers(1, 1 << 63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = np.random.default_rng(6).integers(0, 1 << 63, BANDS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 20


def split(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingle_hashes(word_hashes: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each run of five words."""
    n = len(word_hashes) - SHINGLE + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out = (out ^ word_hashes[k : k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _part_minima(hashes: np.ndarray) -> np.ndarray:
    return (hashes[None, :] * _ODD[:, None] + _SHIFT[:, None]).min(1)


def minima(hashes: np.ndarray, largest: int) -> dict[int, np.ndarray]:
    """For each class, the minima (band x window) of all windows of twice the class size."""
    blocks = []
    for at in range(0, len(hashes), PART):
        part = hashes[at : at + PART]
        full = len(part) // SMALLEST_CLASS * SMALLEST_CLASS
        if full:
            permuted = part[None, :full] * _ODD[:, None] + _SHIFT[:, None]
            blocks.append(permuted.reshape(BANDS, -1, SMALLEST_CLASS).min(2))
        if full < len(part):
            blocks.append(_part_minima(part[full:])[:, None])
    level = np.concatenate(blocks, 1)
    out, size = {}, SMALLEST_CLASS
    while size <= largest:
        # windows are two neighbouring blocks; a single block is a window of its own
        out[size] = np.minimum(level[:, :-1], level[:, 1:]) if level.shape[1] > 1 else level
        if level.shape[1] % 2:
            level = np.concatenate((level, np.full((BANDS, 1), np.iinfo(np.uint64).max, np.uint64)), 1)
        level = np.minimum(level[:, 0::2], level[:, 1::2])
        size *= 2
    return out


class Index:
    """The tables of one block of test items: for each size class a sorted array of band keys."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.ids, self.shingles, groups, few = [], [], {}, []
        for item_id, text in items:
            words = split(text)
            shingles = {" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}
            if not shingles:
                continue
            size = SMALLEST_CLASS
            while size < len(shingles):
                size *= 2
            hashes = np.unique(shingle_hashes(np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)))
            if len(shingles) < FEW:
                few += [(h, len(self.ids)) for h in hashes.tolist()]
            else:
                groups.setdefault(size, []).append((len(self.ids), _part_minima(hashes) ^ band_marks()))
            self.ids.append(item_id)
            self.shingles.append(frozenset(shingles))
        few.sort()
        self.few = (np.array([h for h, _ in few], np.uint64), [k for _, k in few])
        self.largest = max(groups, default=0)
        self.tables = {}
        for size, members in groups.items():
            keys = np.concatenate([k for _, k in members])
            owner = np.repeat(np.array([i for i, _ in members]), BANDS)
            order = np.argsort(keys, kind="stable")
            present = np.zeros(1 << _TABLE_BITS, bool)
            present[keys >> np.uint64(64 - _TABLE_BITS)] = True
            self.tables[size] = (keys[order], owner[order], present)

    @classmethod
    def of(cls, fields: dict) -> Index:
        """The index with the fields of another: broadcasts hold plain values, since workers have no copy of the class."""
        index = cls.__new__(cls)
        index.__dict__.update(fields)
        return index

    def candidates(self, hashes: np.ndarray) -> set[int]:
        found: set[int] = set()
        if not len(hashes):
            return found
        keys, owner = self.few
        if len(keys):
            low, high = np.searchsorted(keys, hashes, "left"), np.searchsorted(keys, hashes, "right")
            for a, b in set(zip(low[high > low].tolist(), high[high > low].tolist())):
                found.update(owner[a:b])
        if not self.tables:
            return found
        for size, values in minima(hashes, self.largest).items():
            if size not in self.tables:
                continue
            keys, owner, present = self.tables[size]
            probes = (values ^ band_marks()[:, None]).ravel()
            probes = np.unique(probes[present[probes >> np.uint64(64 - _TABLE_BITS)]])
            low, high = np.searchsorted(keys, probes, "left"), np.searchsorted(keys, probes, "right")
            for a, b in zip(low[high > low].tolist(), high[high > low].tolist()):
                found.update(owner[a:b].tolist())
        return found


def band_marks() -> np.ndarray:
    """Keeps equal minima of different bands apart."""
    return np.arange(BANDS, dtype=np.uint64) * _MIX


def _blocks(items: DataFrame, block_chars: int) -> list[DataFrame]:
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-size // block_chars) or 1
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [items.where(number == k) for k in range(count)]


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, n_shared, n_item and containment of every pair at or above ``threshold``."""
    spark = docs.sparkSession
    items = items.select("item_id", "text")
    kind = {"doc_id": docs.schema["doc_id"].dataType.simpleString(), "item_id": items.schema["item_id"].dataType.simpleString()}
    schema = f"doc_id {kind['doc_id']}, item_id {kind['item_id']}, n_shared long, n_item long, containment double"
    out = None
    for block in _blocks(items, block_chars):
        index = spark.sparkContext.broadcast(vars(Index(sorted(map(tuple, block.collect()), key=repr))))

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            table = Index.of(index.value)

            class Words(dict):
                def __missing__(self, word: str) -> int:
                    if len(self) >= CACHED_WORDS:
                        self.clear()
                    value = self[word] = xxhash.xxh64_intdigest(word)
                    return value

            known = Words()
            for batch in batches:
                found = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    words = split(text)
                    hashes = shingle_hashes(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
                    proposed = sorted(table.candidates(hashes))
                    if not proposed:
                        continue
                    own = {" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}
                    for k in proposed:
                        shared, size = len(table.shingles[k] & own), len(table.shingles[k])
                        if shared >= threshold * size:
                            found.append((doc_id, table.ids[k], shared, size, shared / size))
                columns = list(zip(*found)) if found else [()] * 5
                kinds = [batch.schema.field("doc_id").type, item_type, pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "item_id", "n_shared", "n_item", "containment"])

        item_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind["item_id"]]
        pairs = docs.select("doc_id", "text").mapInArrow(search, schema)
        out = pairs if out is None else out.unionByName(pairs)
    return out


def clean(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """``docs`` without those that hold a test item; all their columns, whatever their names, are kept."""
    key = F.xxhash64("doc_id", "text")
    # the search sees a key of its own, so that null and repeated ids are told apart by their texts
    keyed = docs.select(key.alias("doc_id"), "text")
    name = unused(docs)
    hits = contaminated(keyed, items, threshold).select(F.col("doc_id").alias(name)).distinct()
    return docs.withColumn(name, key).join(hits, name, "left_anti").drop(name)
