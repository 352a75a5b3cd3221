"""Hard negatives by inner product, with coordinate pruning after the manner of LEMP.

Rows are dealt into length buckets: they are spread over tasks by ranges of their norm and searched in
blocks of like norm.  A block holds, for each coordinate of its normalised vectors, the list of rows
sorted by that coordinate.  For an anchor and a score that it must reach, the block's largest norm gives
the least cosine that can do; a block that cannot is passed over whole.  Otherwise each of the anchor's
``FOCUS`` largest coordinates has a feasible range of values, a run of the block's sorted list; rows in
the runs of all focus coordinates are candidates, and these alone are scored exactly.

Anchors are a stated query set: they are taken in blocks of ``ANCHORS``, and each block is broadcast to
a pass over all rows.  Every task keeps the best rows of each anchor as it goes, so that later blocks
meet a higher bar; what is shuffled are the few rows that a task has kept for an anchor, whatever the
number of rows of a label.  The first pass finds the positives, the second the negatives between each
positive's bounds.

Scores are whole numbers: each component is floor(256 * x).  Edge cases: rows with a null label or
vector, with a null or non-finite component, or too long for a score to fit 64 bits (norm over 2**28)
take no part; vectors of unequal length are compared as if the shorter ended in zeros; an empty vector
scores 0; a row with a null id is no anchor and comes last among equal scores; repeated rows count each
for itself, but no row of the anchor's own id is its positive or negative; anchors that are equal in all
count once; without anchors, or on an empty table, the result is empty.  Only ``vec_id``, ``embedding``
and ``label`` are read: other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from telemark.llm.shared import durable

SCALE = 256
#: Anchors that are broadcast at once.
ANCHORS = 4096
BLOCK = 4096
FOCUS = 3
#: Anchors whose candidates are marked at once.
STEP = 64
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between this many hundredths of the positive's score and the whole of it.
LOW, HIGH = 80, 100
LAST = np.iinfo(np.int64).max
#: So that a hundred times a score fits 64 bits.
MAX_NORM = 2.0**28


def prepared(rows: DataFrame) -> DataFrame:
    """vec_id, label and whole-numbered vector of the rows that take part, with their norm."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= MAX_NORM))
    taking = rows.select("vec_id", "label", "embedding").where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    whole = taking.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), vector.alias("vector")).withColumn("norm", norm)
    return whole.where(F.col("norm") <= MAX_NORM).withColumn("vector", F.col("vector").cast("array<int>"))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows, ended with zeros up to ``width`` or the longest of them."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(int(lengths.max(initial=0)), width or 0)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def product(left: np.ndarray, right: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products of all rows of ``left`` and ``right``, none beyond ``bound``."""
    if bound < 2.0**52:  # every partial sum is a whole number that a double holds
        return np.rint(left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


class Bucket:
    """Rows of like norm with a sorted list of places for each coordinate."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        self.norm = float(norms.max(initial=0))
        unit = vectors / np.where(norms > 0, norms, 1)[:, None]
        self.lists = np.argsort(unit, axis=0, kind="stable")
        self.values = np.take_along_axis(unit, self.lists, 0)

    def candidates(self, unit: np.ndarray, norms: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Anchors that some row may give ``least``, and for each of them which rows those may be.

        ``unit`` and ``norms`` are the anchors' normalised vectors and norms.
        """
        reach = norms * self.norm
        cosine = np.where(least > 0, least / np.where(reach > 0, reach, 1) * (1 - 1e-12), -1.0)
        alive = np.flatnonzero((least <= 0) | ((reach > 0) & (cosine <= 1)))
        unit, angle = unit[alive], np.arccos(np.clip(cosine[alive], -1, 1))
        rows, width = self.vectors.shape[0], min(unit.shape[1], self.vectors.shape[1])
        focus = np.argsort(-np.abs(unit[:, :width]), axis=1, kind="stable")[:, :FOCUS]
        low, high = np.zeros(focus.shape, np.int64), np.full(focus.shape, rows, np.int64)
        for coordinate in np.unique(focus).tolist():
            where = np.nonzero(focus == coordinate)
            own = np.arccos(np.clip(unit[where[0], coordinate], -1, 1))
            # the unit vectors within ``angle`` of the anchor have this coordinate between two cosines; a
            # little is added for rounding, and anchors without a bar take whole lists
            free = cosine[alive][where[0]] <= -1
            least_value = np.where(free, -np.inf, np.cos(np.minimum(own + angle[where[0]], np.pi)) - 1e-9)
            most_value = np.where(free, np.inf, np.cos(np.maximum(own - angle[where[0]], 0)) + 1e-9)
            low[where] = np.searchsorted(self.values[:, coordinate], least_value, "left")
            high[where] = np.searchsorted(self.values[:, coordinate], most_value, "right")
        marks = np.zeros((len(alive), rows), np.int8)
        for k in range(focus.shape[1]):
            for i in range(len(alive)):
                a, b = low[i, k], high[i, k]
                if b - a == rows:
                    marks[i] += 1
                else:
                    marks[i, self.lists[a:b, focus[i, k]]] += 1
        return alive, marks == focus.shape[1]


def best(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` best rows of each query: high scores first, then small ids."""
    order = np.lexsort((vec_id, -score, query))
    ordered = query[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, bool)
    starts = np.flatnonzero(first)
    rank = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(ordered)]))))
    return order[rank < most]


class Search:
    """Best rows so far of the queries of a block of anchors.

    A query is an anchor with the bounds ``low`` (in hundredths, like ``high``) and ``high`` of a score and
    with the labels it asks for: its own or all others.
    """

    def __init__(self, anchors: dict[str, np.ndarray], queries: dict[str, np.ndarray], same: bool, most: int):
        self.vectors, self.labels, self.ids = anchors["vector"], anchors["label"], anchors["vec_id"]
        self.norms = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(1))
        self.unit = self.vectors / np.where(self.norms > 0, self.norms, 1)[:, None]
        self.owner, self.low, self.high = queries["anchor"], queries["low"], queries["high"]
        self.same, self.most = same, most
        self.bar = self.low.copy()  # hundredths of a score below which a row cannot count any more
        self.query, self.score, self.vec_id = (np.empty(0, np.int64) for _ in range(3))
        # queries of each anchor as rows of a table, filled up with -1
        counts = np.bincount(self.owner, minlength=len(self.ids))
        self.table = np.full((len(self.ids), max(int(counts.max(initial=0)), 1)), -1)
        order = np.argsort(self.owner, kind="stable")
        self.table[np.repeat(np.arange(len(self.ids)), counts), np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)] = order

    def take(self, vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> None:
        """Search one block of rows for all anchors."""
        width = max(vectors.shape[1], self.vectors.shape[1])
        pad = [np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (vectors, self.vectors, self.unit)]
        bucket = Bucket(pad[0])
        for at in range(0, len(self.ids), STEP):
            part = slice(at, at + STEP)
            asked = self.table[part]
            bars = np.where(asked >= 0, self.bar[asked] if len(self.bar) else 0, LAST).min(1)
            asking = np.flatnonzero(bars < LAST)
            if not len(asking):
                continue
            least = -(-bars[asking] // 100)
            alive, marks = bucket.candidates(pad[2][part][asking], self.norms[part][asking], np.where(bars[asking] <= -LAST // 2, -1, least).astype(np.float64))
            if not len(alive):
                continue
            asking = asking[alive]
            marks &= (labels[None, :] == self.labels[part][asking][:, None]) == self.same
            marks &= ids[None, :] != self.ids[part][asking][:, None]
            rows = np.flatnonzero(marks.any(0))
            if not len(rows):
                continue
            scores = product(pad[1][part][asking], bucket.vectors[rows], float(self.norms[part].max(initial=0)) * bucket.norm)
            which, place = np.nonzero(marks[:, rows] & (scores >= least[alive][:, None]))
            found, found_id = scores[which, place], ids[rows[place]]
            for k in range(asked.shape[1]):
                query = asked[asking[which], k]
                fits = query >= 0
                fits[fits] = (100 * found[fits] >= self.bar[query[fits]]) & (100 * found[fits] <= self.high[query[fits]])
                if fits.any():
                    self._keep(query[fits], found[fits], found_id[fits])

    def _keep(self, query: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        mine = best(query, score, vec_id, self.most)  # so that what is held stays small
        query, score, vec_id = (np.concatenate(x) for x in ((self.query, query[mine]), (self.score, score[mine]), (self.vec_id, vec_id[mine])))
        kept = best(query, score, vec_id, self.most)
        self.query, self.score, self.vec_id = query[kept], score[kept], vec_id[kept]
        counts = np.bincount(self.query, minlength=len(self.bar))
        full = np.flatnonzero(counts >= self.most)
        ends = np.cumsum(counts)[full] - 1
        self.bar[full] = np.maximum(self.bar[full], 100 * self.score[ends])


def _pass(rows: DataFrame, anchors: dict, queries: dict, same: bool, most: int) -> DataFrame:
    """anchor and query (places in the broadcast block), vec_id and score of the rows that each task keeps."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*shared.value, same, most)
        held, size = [], 0

        def block() -> None:
            whole = pa.Table.from_batches(held).combine_chunks()
            ids = whole.column("vec_id").fill_null(LAST).to_numpy()
            vectors = whole.column("vector").combine_chunks()
            search.take(matrix(vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors), whole.column("label").to_numpy(), ids)

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                held.append(batch.slice(at, BLOCK))
                size += held[-1].num_rows
                if size >= BLOCK:
                    block()
                    held, size = [], 0
        if held:
            block()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(search.owner[search.query].astype(np.int32)), pa.array(search.query.astype(np.int32)),
                pa.array(search.vec_id, pa.int64(), mask=search.vec_id == LAST), pa.array(search.score),
            ],
            ["anchor", "query", "vec_id", "score"],
        )

    found = rows.select("vec_id", "label", "vector").mapInArrow(run, "anchor int, query int, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(rows: DataFrame, anchor: DataFrame | None = None, anchors_at_once: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of all hard negatives.

    ``anchor`` chooses the anchors (a condition on ``vec_id``); by default those whose id is divisible by 100.
    """
    spark = rows.sparkSession
    whole = prepared(rows)
    buckets = durable(whole.repartitionByRange(F.desc("norm"), F.col("vec_id")).sortWithinPartitions(F.desc("norm"), "vec_id"), "buckets")
    chosen = whole.where(F.col("vec_id") % 100 == 0 if anchor is None else anchor).select("vec_id", "label", "vector").distinct()
    count = chosen.count()
    blocks = max(1, -(-count // anchors_at_once))
    number = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks))
    out = None
    for k in range(blocks):
        block = chosen.where(number == k).orderBy("vec_id", "label", "vector").toArrow().combine_chunks()
        vectors = block.column("vector").combine_chunks() if block.num_rows else pa.array([], pa.list_(pa.int32()))
        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
        anchors = {"vec_id": block.column("vec_id").to_numpy(), "label": block.column("label").to_numpy(), "vector": matrix(vectors)}
        n = block.num_rows
        everything = {"anchor": np.arange(n), "low": np.full(n, -LAST), "high": np.full(n, LAST)}
        # at most five rows an anchor of this block
        positives = durable(_pass(buckets, anchors, everything, True, POSITIVES).select("anchor", "rank", "vec_id", "score"), "positives").orderBy("anchor", "rank").toArrow()
        owner, score = positives.column("anchor").to_numpy().astype(np.int64), positives.column("score").to_numpy()
        bounds = {"anchor": owner, "low": LOW * score, "high": HIGH * score}
        names = spark.createDataFrame(
            pa.table({
                "query": pa.array(np.arange(len(owner), dtype=np.int32)), "anchor_id": pa.array(anchors["vec_id"][owner]),
                "positive_id": positives.column("vec_id"), "positive_score": positives.column("score"),
            })
        )
        found = _pass(buckets, anchors, bounds, False, NEGATIVES).join(F.broadcast(names), "query")
        found = found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = found if out is None else out.unionByName(found)
    return out
