"""Near copies by Jaccard similarity of five-word shingles: SimHash and MinHash bands propose, exact sets decide.

SimHash comes first, as in ``simhash``: fingerprints of two bits or fewer apart link through the anchors
they share, and texts of one component meet.  Two texts of similarity 0.8 often lie further apart, so
MinHash bands let the rest meet.

Every text is the set of its runs of five words in lower case, as 64-bit hashes; a text of one to four
words is one run.  Texts of equal sets collapse first.  Each set has 128 minima in 32 bands of four, and
two sets of similarity s meet in some band with probability 1 - (1 - s**4)**32: all but 5e-8 of the
pairs at 0.8.  Texts that meet are linked only if the exact similarity of their sets reaches the
threshold.

Stored and shuffled are digests, sizes, fingerprints and bands; the shingles of texts that meet no other are never
kept.  Texts that do meet are read once more.  In each band every member is first compared with the
smallest member, which joins most groups of near copies into one component at a link a member.  Only bands
whose members are still in several components are searched further: all members outside the largest
component are compared with all members of others.  Both sides are dealt into blocks of
``BLOCK_SHINGLES``, a task for each pair, so the memory of a task is bounded whatever the size of a band.

Links become components as for SimHash.  Edge cases: a null text counts as empty; texts without words
are copies of one another; null ids and repeated rows take part like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from telemark.llm.contamination import SHINGLE, shingle_hashes
from telemark.llm.shared import durable
from telemark.llm.simhash import components, fingerprint, groups

SIMILARITY = 0.8
BANDS = 32
ROWS = 4
BLOCK_SHINGLES = 1 << 20
PART = 8192
CACHED_WORDS = 200_000

_ODD = np.random.default_rng(7).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = np.random.default_rng(8).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


class Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: bytes | None, known: Words) -> np.ndarray:
    """The sorted hashes of the text's distinct runs of five words."""
    words = (text or b"").lower().split()  # on bytes both touch ASCII only
    if 0 < len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], np.uint64)
    return np.unique(shingle_hashes(np.fromiter(map(known.__getitem__, words), np.uint64, len(words))))


def bands(hashes: np.ndarray) -> np.ndarray:
    """One key for each band; none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), PART):
        low = np.minimum(low, (hashes[None, at : at + PART] * _ODD[:, None] + _SHIFT[:, None]).min(1))
    rows = low.astype("<u8").reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(rows)], np.uint64).view(np.int64)


def _digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes())


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, size and bands of each text's set, and the text's SimHash fingerprint."""
    known = Words()
    for whole in batches:
        for batch in (whole.slice(at, 1024) for at in range(0, whole.num_rows, 1024)):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            sets = [shingles(t, known) for t in texts]
            prints = pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))
            others = [n for n in batch.schema.names if n != "text"]
            made = [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array([bands(s) for s in sets], pa.list_(pa.int64())), prints]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), *made], [*others, "digest", "n", "bands", "fingerprint"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and shingles of each text."""
    known = Words()
    for whole in batches:
        for batch in (whole.slice(at, 256) for at in range(0, whole.num_rows, 256)):
            sets = [shingles(t, known) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_pydict({"digest": pa.array([_digest(s) for s in sets], pa.binary()), "hashes": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})


def search(pivots: list[np.ndarray], targets: list[np.ndarray], owners: list[bytes], names: list[bytes], similarity: float = SIMILARITY) -> list[tuple[bytes, bytes]]:
    """Links (``owners`` of pivots to ``names`` of targets) between components, by exact Jaccard ``similarity``.

    Owners and names are the components that the sets are in already; pairs within one are not compared.
    """
    if not pivots or not targets:
        return []
    above: dict[bytes, bytes] = {}

    def root(name: bytes) -> bytes:
        while name in above:
            name = above[name]
        return name

    place = np.unique(np.concatenate([*targets, *pivots]), return_inverse=True)[1]
    sizes = np.array([len(s) for s in targets])
    flat, rest = place[: sizes.sum()], place[sizes.sum() :]
    starts = np.cumsum(sizes) - sizes
    marks = np.zeros(len(place), bool)
    groups = np.array([hash(n) for n in names])
    links, at = [], 0
    for pivot, owner in zip(pivots, owners):
        own = rest[at : at + len(pivot)]
        at += len(pivot)
        fits = np.flatnonzero((groups != hash(owner)) & (np.minimum(sizes, len(pivot)) >= similarity * np.maximum(sizes, len(pivot))))
        open_ = np.array([k for k in fits.tolist() if root(names[k]) != root(owner)], np.int64)
        if not len(open_):
            continue
        marks[own] = True
        lengths = sizes[open_]
        ends = np.cumsum(lengths)
        chosen = flat[np.repeat(starts[open_] - (ends - lengths), lengths) + np.arange(ends[-1])]
        shared = np.add.reduceat(marks[chosen], ends - lengths, dtype=np.int64)
        marks[own] = False
        for k in open_[shared >= similarity * (len(pivot) + lengths - shared)].tolist():
            a, b = root(owner), root(names[k])
            if a != b:
                above[max(a, b)] = min(a, b)
                links.append((max(owner, names[k]), min(owner, names[k])))
    return links


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each key; rows come sorted by key, and a key's rows may span batches."""
    key, held = None, ([], [], [], [])

    def links() -> pa.RecordBatch:
        pairs = search(*held)
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("band", "x", "y", "pivot", "component")]
        raw = batch.column("hashes")
        flat, offsets = raw.flatten().to_numpy(zero_copy_only=False).view(np.uint64), raw.offsets.to_numpy() - raw.offsets[0].as_py()
        for k, (band, x, y, pivot, component) in enumerate(zip(*columns)):
            if (band, x, y) != key:
                yield links()
                key, held = (band, x, y), ([], [], [], [])
            held[0 if pivot else 1].append(flat[offsets[k] : offsets[k + 1]].copy())
            held[2 if pivot else 3].append(component)
    yield links()


def near_copies(docs: DataFrame, extra: tuple[str, ...] = (), block_shingles: int = BLOCK_SHINGLES, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, ``extra`` columns, digest of the set of shingles and group (a digest that names the component)."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", *extra))
    row = F.xxhash64("doc_id", "text")
    texts = durable(
        docs.select("doc_id", *extra, row.alias("row"), "text").mapInArrow(_sketches, f"{kinds}, row long, digest binary, n long, bands array<long>, fingerprint long"), "sketches"
    )
    distinct = durable(texts.groupBy("digest").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("row").alias("row")), "distinct")
    banded = distinct.select("digest", "n", F.explode("bands").alias("band"))
    # texts of one SimHash component meet under the hash of its name
    named = durable(groups(texts.select("fingerprint").distinct()).select("fingerprint", F.xxhash64(F.lit("simhash"), "group").alias("band")), "simhash")
    printed = texts.select("digest", "n", "fingerprint").distinct().join(named, "fingerprint")
    keyed = banded.unionByName(printed.select("digest", "n", "band").distinct())
    met = keyed.groupBy("band").agg(F.count("*").alias("members"), F.min(F.struct("digest", "n")).alias("least")).where("members > 1")
    members = durable(keyed.join(met.select("band", "least"), "band"), "members")

    # the shingles of the texts that meet others, each set once
    wanted = distinct.join(members.select("digest").distinct(), "digest", "left_semi").select("row")
    again = docs.select(row.alias("row"), "text").join(wanted, "row", "left_semi").dropDuplicates(["row"])
    sets = durable(again.select("text").mapInArrow(_hashes, "digest binary, hashes array<long>").dropDuplicates(["digest"]), "shingles")

    # each member against the smallest of its band
    close = F.least("n", "least.n") >= similarity * F.greatest("n", "least.n")
    pairs = members.where(close & (F.col("digest") != F.col("least.digest"))).select("digest", F.col("least.digest").alias("least")).distinct()
    both = pairs.join(sets, "digest").join(sets.select(F.col("digest").alias("least"), F.col("hashes").alias("others")), "least")
    shared = F.size(F.array_intersect("hashes", "others"))
    alike = both.where(shared >= similarity * (F.size("hashes") + F.size("others") - shared))
    first = durable(alike.select(F.greatest("digest", "least").alias("a"), F.least("digest", "least").alias("b")), "first-links")
    joined = durable(components(first), "first-components")

    # bands that are still in pieces: members outside the largest piece against all others
    pieces = members.join(joined, members.digest == joined.node, "left").select("band", "digest", "n", F.coalesce("root", "digest").alias("component"))
    largest = (
        pieces.groupBy("band", "component").agg(F.sum("n").alias("size"), F.count("*").alias("members"))
        .groupBy("band").agg(F.max_by("component", F.struct("members", "component")).alias("main"), F.max("members").alias("most"), F.sum("members").alias("members"), F.sum("size").alias("size"))
        .where("most < members")
    )
    open_ = pieces.join(largest, "band").select("band", "digest", "n", "component", "size", (F.col("component") != F.col("main")).alias("outside"))
    mark = F.xxhash64("digest")
    # bands of equal members are searched once
    named = open_.groupBy("band").agg(
        F.sum(F.when(F.col("outside"), F.col("n")).otherwise(0)).alias("pivots"), F.first("size").alias("size"),
        F.count("*").alias("members"), F.bit_xor(mark).alias("m1"), F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("m2"),
    )
    blocks = lambda c: F.greatest(F.ceil(F.col(c) / block_shingles), F.lit(1)).cast("long")
    searched = named.groupBy("members", "size", "m1", "m2").agg(F.min("band").alias("band"), F.max("pivots").alias("pivots"))
    dealt = open_.drop("size").join(searched.select("band", blocks("pivots").alias("rows"), blocks("size").alias("columns")), "band")
    every = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    own = F.pmod(mark, F.col("rows")), F.pmod(mark, F.col("columns"))
    targets = dealt.select("band", "digest", "component", F.lit(False).alias("pivot"), F.explode(every("rows")).alias("x"), own[1].alias("y"))
    pivots = dealt.where("outside").select("band", "digest", "component", F.lit(True).alias("pivot"), own[0].alias("x"), F.explode(every("columns")).alias("y"))
    keys = ["band", "x", "y"]
    work = targets.unionByName(pivots).join(sets, "digest").select(*keys, "pivot", "component", "hashes")
    later = work.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compare, "a binary, b binary")
    roots = components(first.unionByName(joined.select(F.col("node").alias("a"), F.col("root").alias("b"))).unionByName(later))
    found = texts.select("doc_id", *extra, "digest")
    return found.join(roots, found.digest == roots.node, "left").select("doc_id", *extra, "digest", F.coalesce("root", "digest").alias("group"))
