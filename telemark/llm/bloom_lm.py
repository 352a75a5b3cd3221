"""Language-model scores from a log-frequency Bloom filter.

Counts of single tokens and of pairs are kept as logarithmic levels: an n-gram of level q is entered
under the keys (n-gram, 1) to (n-gram, q), and a look-up probes 1, 2, ... until a key is missing.  A level
is never above the count that it stands for, so the filter has ``BITS_PER_ENTRY`` bits or more for each
entry at every size.  It is a table of segments in shared storage, each built by the task that holds all
counts of the segment.  Segments are broadcast to the workers in blocks of ``BLOCK_SEGMENTS``, a bounded
number of bytes; each block is probed with the n-grams of the texts that fall into it, which lie in a
folder of its own, and what is shuffled back are levels of one byte.  So every n-gram is looked up once
at any size of the filter.

The model is p(w | u) = (c(u, w) + K p(w)) / (c(u) + K) with p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)),
which sums to one over all words but for rounding to levels and false levels.

``base_score`` needs exact counts: the most frequent tokens come from a table of fixed size in every
task, all others are joined with the table of counts.

Tokens are words in lower case (A-Z only) and one end per text; the context of the first is a start
mark.  Tokens are told apart by a 64-bit hash.  Edge cases: a null text has the end token alone; a
null id counts as the empty text in the choice of training rows; repeated rows get equal scores; with
no training rows N and V are zero, and every token is unknown.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from telemark.llm.shared import durable, free_shuffles, remove, scratch

BITS_PER_ENTRY = 10
MIN_BITS = 1 << 16
PROBES = 3
LEVEL_BASE = 1.4
MAX_LEVEL = 120
SEGMENTS = 64
#: Bits of a segment at most; a larger filter has more segments.
SEGMENT_BITS = 1 << 23
#: Segments that are broadcast at once: 64 MB at most.
BLOCK_SEGMENTS = 64
#: Segments that one task builds; each has fewer counts than its bits divided by ``BITS_PER_ENTRY``.
TASK_SEGMENTS = 2
#: Bytes of text that are hashed at once, keys that are looked up at once, and counts that are packed at once.
BLOCK_BYTES = 1 << 18
BLOCK_KEYS = 1 << 16
BLOCK_COUNTS = 1 << 21
#: Tokens whose look-ups travel together.
FRAME = 1 << 18
STRENGTH = 4.0  # K: how many pairs the single-token distribution is worth
ADDED = 0.1
#: Tokens whose exact counts are broadcast; all others are joined.
FREQUENT = 1 << 18

END = np.uint64(xxhash.xxh64_intdigest(b" end"))  # no word contains white space
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
START = np.uint64(xxhash.xxh64_intdigest(b" start"))
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


#: What of a hash is used in the filter: 48 bits, so that a look-up takes six bytes.
KEPT = np.uint64(0xFFFFFFFFFFFF0000)


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * _B
    value = (value ^ (value >> np.uint64(29))) * _C
    return value ^ (value >> np.uint64(32))


def pair(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(context * _A + token)


_LETTERS = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts one after another, and where each text's begin (one place more at the end).

    A word's hash is a polynomial in its bytes, each replaced by a random number: all words of all texts
    are hashed in columns, a block of ``BLOCK_BYTES`` at a time, so that the columns stay in the cache.
    """
    lowered = [(text or b"").lower() for text in texts]
    block = np.cumsum([0, *(len(t) + 1 for t in lowered)])[:-1] // BLOCK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(lowered)]
    parts = [_tokens(lowered[low:high]) for low, high in zip(cuts, cuts[1:])]
    ends = np.cumsum([0, *(len(found) for found, _ in parts)])
    bounds = [bounds[:-1] + end for (_, bounds), end in zip(parts, ends)]
    return np.concatenate([found for found, _ in parts]), np.concatenate([*bounds, ends[-1:]]).astype(np.int64)


def _tokens(lowered: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"\n".join([*lowered, b""]), np.uint8)
    space = _SPACE[raw]
    begins = ~space
    begins[1:] &= space[:-1]
    starts = np.flatnonzero(begins)
    letters = raw[~space]
    own = np.append(np.cumsum(~space)[starts] - 1, len(letters))
    lengths = np.diff(own)
    powers = np.cumprod(np.full(int(lengths.max(initial=1)), _A))
    values = _LETTERS[letters] * powers[np.arange(len(letters)) - np.repeat(own[:-1], lengths)]
    hashes = mix(np.add.reduceat(values, own[:-1]) ^ lengths.astype(np.uint64) * _B) if len(starts) else np.empty(0, np.uint64)
    stops = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in lowered]))
    return np.insert(hashes, stops, END), np.concatenate(([0], stops + np.arange(1, len(lowered) + 1))).astype(np.int64)


def contexts(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    before = np.concatenate((np.array([START]), tokens[:-1])) if len(tokens) else tokens
    before = before.copy()
    before[bounds[:-1]] = START
    return before


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, each with the sum of its counts."""
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")
    all_keys, all_counts = all_keys[order], all_counts[order]
    first = np.flatnonzero(np.concatenate(([True], all_keys[1:] != all_keys[:-1]))) if len(all_keys) else np.empty(0, np.int64)
    return all_keys[first], np.add.reduceat(all_counts, first) if len(first) else all_counts


def _plain(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(keys), 100_000):
        part = slice(at, at + 100_000)
        yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), pa.array(counts[part])], ["h", "n"])


def _by_segment(segments: int):
    """A row for each segment that has some of the ordered keys, with these and their counts as bytes."""

    def rows(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        owner = segment_of(keys, segments)  # grows with the keys
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        for first in range(0, len(starts), 256):
            some = starts[first : first + 256].tolist()
            ends = starts[first + 1 : first + 257].tolist()
            cuts = list(zip(some, ends if len(ends) == len(some) else [*ends, len(keys)]))
            parts = [[column[low:high].tobytes() for low, high in cuts] for column in (keys, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(owner[some], pa.int32()), *(pa.array(p, pa.binary()) for p in parts)], ["segment", "h", "n"])

    return rows


def _counter(pairs: bool, rows=_plain):
    """Counts of tokens, or of pairs of tokens, summed within a task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting = np.empty(0, np.uint64), np.empty(0, np.int64), []
        held = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _summed([keys, *waiting], [counts, *(np.ones(len(w), np.int64) for w in waiting)])

        for batch in _slices(batches):
            found, bounds = tokens(batch.column("text").cast(pa.binary()).to_pylist())
            waiting.append(pair(contexts(found, bounds), found) if pairs else found)
            held += len(found)
            if held >= 2_000_000:
                keys, counts = merged()
                waiting, held = [], 0
                if len(keys) >= 6_000_000:
                    yield from rows(keys, counts)
                    keys, counts = keys[:0], counts[:0]
        keys, counts = merged()
        yield from rows(keys, counts)

    return run


def _packer(segments: int):
    """Counts (h, n) as rows of segments."""
    rows = _by_segment(segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for batch in batches:
            keys.append(batch.column("h").to_numpy().view(np.uint64))
            counts.append(batch.column("n").to_numpy())
            if sum(map(len, keys)) >= BLOCK_COUNTS:
                yield from rows(*_summed(keys, counts))
                keys, counts = keys[:1], counts[:1]
        yield from rows(*_summed(keys, counts))

    return run


def _thresholds() -> np.ndarray:
    """The smallest count of each level: one apart at first, then by the factor ``LEVEL_BASE``."""
    out = [1]
    while len(out) < MAX_LEVEL:
        out.append(max(out[-1] + 1, int(out[-1] * LEVEL_BASE)))
    return np.array(out, np.float64)


THRESHOLDS = _thresholds()


def level(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(THRESHOLDS, counts, "right")


def level_value(levels: np.ndarray) -> np.ndarray:
    """The count that stands for a level: the middle of the whole numbers on it; 0 for level 0."""
    low = np.concatenate(([0.0], THRESHOLDS))
    high = np.concatenate(([0.0], THRESHOLDS[1:] - 1, THRESHOLDS[-1:]))
    return ((low + high) / 2)[levels]


def entry(keys: np.ndarray, levels: np.ndarray | int) -> np.ndarray:
    return mix(keys + np.asarray(levels).astype(np.uint64) * _A)


def stride(entries: np.ndarray) -> np.ndarray:
    """How far the probes of an entry lie apart."""
    return mix(entries ^ _C) | np.uint64(1)


def places(keys: np.ndarray, levels: np.ndarray | int, segment_bits: int) -> Iterator[np.ndarray]:
    """Bit places within a segment of the keys' entries at ``levels``, one array for each probe."""
    at = entry(keys, levels)
    step = stride(at)
    for k in range(PROBES):
        yield (at + np.uint64(k) * step) & np.uint64(segment_bits - 1)


def levels_of(keys: np.ndarray, bits: np.ndarray, segment: np.ndarray, segment_bits: int) -> np.ndarray:
    """Levels of ``keys``, each looked up in its ``segment`` of the bit array.

    Keys are taken by segment, a block at a time: both their columns and the bits that they need fit the cache.
    """
    out = np.zeros(len(keys), np.int64)
    order = np.argsort(segment.astype(np.uint16), kind="stable")
    last = np.uint64(segment_bits - 1)

    def is_set(at: np.ndarray) -> np.ndarray:
        found = bits.take((at >> np.uint64(3)).view(np.int64)) >> (at.astype(np.uint8) & np.uint8(7)) & np.uint8(1)
        return np.flatnonzero(found.view(bool))

    for start in range(0, len(order), BLOCK_KEYS):
        active = order[start : start + BLOCK_KEYS]
        alive, base = keys[active], segment[active].astype(np.uint64) * np.uint64(segment_bits)
        for q in range(1, MAX_LEVEL + 1):
            at = entry(alive, q)
            there = is_set(base + (at & last))
            at = at[there]
            step = stride(at)
            for k in range(1, PROBES):
                kept = is_set(base[there] + ((at + np.uint64(k) * step) & last))
                there, at, step = there[kept], at[kept], step[kept]
            active, alive, base = active[there], alive[there], base[there]
            if not len(active):
                break
            out[active] = q
    return out


def token_scores(counts: np.ndarray, before: np.ndarray, pairs: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """log10 probabilities of tokens from their counts, those of the tokens before them and those of the pairs."""
    alone = (counts + ADDED) / (total + ADDED * (distinct + 1))
    return np.log10((np.minimum(pairs, before) + STRENGTH * alone) / (before + STRENGTH))


def segment_of(keys: np.ndarray, segments: int = SEGMENTS) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def layout(entries: int, segment_bits: int = SEGMENT_BITS) -> tuple[int, int]:
    """Number of segments and bits of each: ``BITS_PER_ENTRY`` or more for each entry, whatever their number."""
    bits = MIN_BITS // SEGMENTS
    while bits < segment_bits and bits * SEGMENTS < BITS_PER_ENTRY * entries:
        bits *= 2
    return max(SEGMENTS, -(-BITS_PER_ENTRY * entries // bits)), bits


def segment_bytes(keys: np.ndarray, counts: np.ndarray, segment_bits: int) -> bytes:
    """The bit array of a segment's keys."""
    bits = np.zeros(segment_bits, bool)
    mine, deep = keys & KEPT, level(counts)
    q = 1
    while len(mine):
        for place in places(mine, q, segment_bits):
            bits[place.view(np.int64)] = True
        mine, deep = mine[deep > q], deep[deep > q]
        q += 1
    return np.packbits(bits, bitorder="little").tobytes()


def _segments(segment_bits: int, segments: int = SEGMENTS):
    """Bit arrays of the segments that a task holds all counts of; counts (h, n) may come packed by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        packed = (p for batch in batches for p in ([batch] if "segment" in batch.schema.names else _packer(segments)([batch])))
        for batch in packed:
            for number, *raw in zip(batch.column("segment").to_pylist(), *(batch.column(c).to_pylist() for c in "hn")):
                held.setdefault(number, []).append(raw)
        while held:
            number, parts = held.popitem()
            keys, counts = _summed([np.frombuffer(h, np.uint64) for h, _ in parts], [np.frombuffer(n, np.int64) for _, n in parts])
            yield pa.RecordBatch.from_pydict({"segment": pa.array([number], pa.int32()), "bits": [segment_bytes(keys, counts, segment_bits)]})

    return run


def train(docs: DataFrame, segment_bits: int = SEGMENT_BITS) -> tuple[str, int, DataFrame, int, int]:
    """The folder of the segments (segment, bits) of the filter of all ``docs`` and their number, the exact counts of single
    tokens (h, n), and the number of tokens and of distinct ones."""
    single = durable(docs.select("text").mapInArrow(_counter(False), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "counts")
    levels = F.size(F.filter(F.array(*(F.lit(float(t)) for t in THRESHOLDS)), lambda t: t <= F.col("n")))
    total, distinct, entries = single.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(levels), F.lit(0))).first()
    segments, bits = layout(total + entries, segment_bits)  # a pair has no more entries than its count
    packed = "segment int, h binary, n binary"
    pairs = docs.select("text").mapInArrow(_counter(True, _by_segment(segments)), packed)
    counted = pairs.unionByName(single.mapInArrow(_packer(segments), packed))
    tasks = -(-segments // TASK_SEGMENTS)  # given, as coalesced tasks would hold more segments at once
    path = scratch(docs.sparkSession, "segments")
    held = counted.repartitionById(tasks, F.call_function("div", F.col("segment"), F.lit(TASK_SEGMENTS)).cast("int"))
    held.mapInArrow(_segments(bits, segments), "segment int, bits binary").write.parquet(path)
    return path, segments, single, total, distinct


def _packed(numbers: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each number."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _planes(codes: np.ndarray) -> bytes:
    """Three bytes a code, all low bytes first: the high ones are nearly all zero, and compress."""
    return np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    low, middle, high = np.frombuffer(raw, np.uint8).reshape(3, -1).astype(np.int64)
    return low | middle << 8 | high << 16


def _unpacked(raw: bytes, width: int) -> np.ndarray:
    parts = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return np.pad(parts, ((0, 0), (0, 8 - width))).view("<u8").ravel()


def frames(found: np.ndarray, bounds: np.ndarray, names: np.ndarray, segments: int, size: int = FRAME) -> Iterator[tuple[dict, dict[int, bytes]]]:
    """Token runs of ``size`` at most with the keys to look up in each block.

    A frame has the distinct tokens' keys (the end first) and then a key for each token's pair.  What is
    kept of it are the places of its tokens among the distinct ones (with that of the token before the
    frame, if a text goes on), the block of each key, and which tokens begin which text's piece.
    """
    before = contexts(found, bounds)
    for start in range(0, len(found), size):
        stop = min(start + size, len(found))
        first = np.searchsorted(bounds, start, "right") - 1
        goes_on = bool(bounds[first] < start)
        codes, distinct = pd.factorize(np.concatenate(([END], found[start - goes_on : stop])))
        keys = np.concatenate((distinct, pair(before[start:stop], found[start:stop]))) & KEPT
        owner = segment_of(keys, segments) // BLOCK_SEGMENTS
        last = np.searchsorted(bounds, stop, "left")
        pieces = np.maximum(bounds[first:last], start) - start
        kept = {
            "codes": _planes(codes[1:]), "owners": _packed(owner, _owner_bytes(segments)), "goes_on": goes_on,
            "pieces": pieces.tolist(), "names": names[first:last].tolist(), "distinct": len(distinct),
        }
        yield kept, {int(b): _packed(keys[owner == b] >> np.uint64(16), 6) for b in np.unique(owner)}


def _owner_bytes(segments: int) -> int:
    return 1 if segments <= 256 * BLOCK_SEGMENTS else 4


def frame_scores(frame: dict, levels: dict[int, bytes], segments: int, total: int, distinct: int) -> np.ndarray:
    """log10 probability of each piece of a frame, from the levels that its blocks gave."""
    owner = _unpacked(frame["owners"], _owner_bytes(segments))
    found = np.zeros(len(owner), np.int64)
    for block, raw in levels.items():
        found[owner == block] = np.frombuffer(raw, np.uint8)
    values = level_value(found)
    counts = values[_from_planes(frame["codes"])]
    pairs = values[frame["distinct"] :]
    pieces = np.array(frame["pieces"], np.int64)
    before = counts[:-1] if frame["goes_on"] else np.concatenate(([0.0], counts[:-1]))
    counts = counts[1:] if frame["goes_on"] else counts
    begin = pieces[1:] if frame["goes_on"] else pieces
    before = before.copy()
    before[begin] = values[0]  # a start is as frequent as an end
    return np.add.reduceat(token_scores(counts, before, pairs, total, distinct), pieces)


def score(docs: DataFrame, held_out: Column, segment_bits: int = SEGMENT_BITS, frame: int = FRAME) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    spark = docs.sparkSession
    filter_path, segments, counts, total, distinct = train(docs.where(~held_out), segment_bits)
    filter_ = spark.read.schema("segment int, bits binary").parquet(filter_path)
    free_shuffles(spark)
    top = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    top_keys, top_counts = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(top_keys)
    frequent = spark.sparkContext.broadcast((top_keys[order], top_counts[order]))
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = f"doc_id {kind}, held_out boolean, n_tokens long, n_frequent long, frequent_score double, mark binary, rest array<long>, rest_n array<long>, name long"
    look = "frame binary, codes binary, owners binary, goes_on boolean, pieces array<int>, names array<long>, `distinct` int, keys binary"
    asked = f"{own}, {look}, block int"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text (block -2), for each frame (-1), and for a frame's keys in each block."""
        keys, known_counts = frequent.value
        schema = None
        number = TaskContext.get().partitionId() << 40
        for batch in _slices(batches, 1024):
            found, bounds = tokens(batch.column("text").cast(pa.binary()).to_pylist())
            texts = batch.num_rows
            if not texts:
                continue
            if schema is None:
                fields = [
                    ("doc_id", batch.schema.field("doc_id").type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_frequent", pa.int64()),
                    ("frequent_score", pa.float64()), ("mark", pa.binary()), ("rest", pa.list_(pa.int64())), ("rest_n", pa.list_(pa.int64())), ("name", pa.int64()),
                    ("frame", pa.binary()), ("codes", pa.binary()), ("owners", pa.binary()), ("goes_on", pa.bool_()), ("pieces", pa.list_(pa.int32())),
                    ("names", pa.list_(pa.int64())), ("distinct", pa.int32()), ("keys", pa.binary()), ("block", pa.int32()),
                ]
                schema = pa.schema(fields)

            def rows(count: int, **columns: object) -> pa.RecordBatch:
                made = [columns[f.name] if f.name in columns else pa.nulls(count, f.type) for f in schema]
                return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(made, schema)], schema=schema)

            names = number + np.arange(texts)
            number += texts
            at, single = pd.factorize(found)
            near = np.minimum(np.searchsorted(keys, single), max(len(keys) - 1, 0))
            single_hit = keys[near] == single if len(keys) else np.zeros(len(single), bool)
            single_logs = np.where(single_hit, np.log10((known_counts[near] + ADDED) / (total + ADDED * (distinct + 1))) if len(keys) else 0.0, 0.0)
            hit = single_hit[at]
            # the tokens that are not in the broadcast table, with their number in each text
            where = np.flatnonzero(~hit)
            text_of = np.searchsorted(bounds, where, "right") - 1
            both, n = np.unique(text_of * len(single) + at[where], return_counts=True)
            ends = pa.array(np.searchsorted(both, np.arange(texts + 1) * len(single)).astype(np.int32))
            marks = [xxhash.xxh3_128_digest(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield rows(
                texts, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), n_tokens=np.diff(bounds),
                n_frequent=np.add.reduceat(hit.astype(np.int64), bounds[:-1]), frequent_score=np.add.reduceat(single_logs[at], bounds[:-1]), mark=marks,
                rest=pa.ListArray.from_arrays(ends, pa.array(single[both % len(single)].view(np.int64))), rest_n=pa.ListArray.from_arrays(ends, pa.array(n)),
                name=names, block=np.full(texts, -2),
            )
            for kept, blocks in frames(found, bounds, names, segments, frame):
                name = uuid.uuid4().bytes
                yield rows(1, frame=[name], **{c: [v] for c, v in kept.items()}, block=[-1])
                yield rows(len(blocks), frame=[name] * len(blocks), keys=list(blocks.values()), block=list(blocks))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores of pieces; rows come sorted by frame, and of each frame the levels by block after the frame itself."""
        name, about, levels = None, None, {}

        def scores() -> pa.RecordBatch:
            values = frame_scores(about, levels, segments, total, distinct) if about else np.empty(0)
            return pa.RecordBatch.from_arrays([pa.array(about["names"] if about else [], pa.int64()), pa.array(values, pa.float64())], ["name", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["frame"] != name:
                    yield scores()
                    name, about, levels = row["frame"], None, {}
                if row["block"] < 0:
                    about = row
                else:
                    levels[row["block"]] = row["keys"]
        yield scores()

    path = scratch(spark, "probes")
    docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(ask, asked).write.partitionBy("block").option("compression", "zstd").parquet(path)
    probes = spark.read.schema(asked).parquet(path)
    found = scratch(spark, "levels")
    for block in range(-(-segments // BLOCK_SEGMENTS)):
        _probe(filter_, probes, block, segments).write.mode("append").parquet(found)
        remove(spark, f"{path}/block={block}")
    remove(spark, filter_path)
    levels = spark.read.schema("frame binary, block int, keys binary").parquet(found)
    columns = [c.split()[0].strip("`") for c in look.split(", ")]
    pieces = probes.where("block = -1").select(*columns, "block").unionByName(levels, allowMissingColumns=True)
    pieces = pieces.repartition("frame").sortWithinPartitions("frame", "block").mapInArrow(answer, "name long, score double")
    sums = durable(pieces.groupBy("name").agg(F.sum("score").alias("score")), "scores")
    del pieces
    remove(spark, found)
    remove(spark, f"{path}/block=-1")
    free_shuffles(spark)
    texts = probes.where("block = -2").select(*(c.split()[0] for c in own.split(", ")))
    return _with_rest(texts.select("name", "mark", "rest", "rest_n"), texts.drop("rest", "rest_n").join(sums, "name"), counts, total, distinct)


def _probe(filter_: DataFrame, probes: DataFrame, block: int, segments: int) -> DataFrame:
    """Levels of all keys of one block of segments, which is broadcast."""
    spark = probes.sparkSession
    first = block * BLOCK_SEGMENTS
    held = filter_.where(F.col("segment").between(first, first + BLOCK_SEGMENTS - 1)).toArrow()  # 64 MB at most
    bits = {n: np.frombuffer(b.as_buffer(), np.uint8) for n, b in zip(held.column("segment").to_pylist(), held.column("bits"))}
    length = max((len(b) for b in bits.values()), default=8)
    whole = np.zeros(BLOCK_SEGMENTS * length, np.uint8)
    for number, own in bits.items():
        whole[(number - first) * length : (number - first + 1) * length] = own
    shared = spark.sparkContext.broadcast(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                keys = _unpacked(batch.column("keys")[k].as_buffer(), 6) << np.uint64(16)
                found = levels_of(keys, bits, segment_of(keys, segments) - first, len(bits) // BLOCK_SEGMENTS * 8)
                yield pa.RecordBatch.from_pydict({"frame": batch.column("frame").slice(k, 1), "block": pa.array([block], pa.int32()), "keys": pa.array([found.astype(np.uint8).tobytes()], pa.binary())})

    return probes.where(F.col("block") == block).select("frame", "keys").mapInArrow(run, "frame binary, block int, keys binary")


def _with_rest(texts: DataFrame, scored: DataFrame, counts: DataFrame, total: int, distinct: int) -> DataFrame:
    """Add the tokens that are not in the broadcast table, by a join with the exact counts.

    Rows of one text are summed together and the sum divided by their number, so that the rows of a
    large group of copies need no key of their own.
    """
    log = F.log10((F.coalesce("c", F.lit(0)) + F.lit(ADDED)) / F.lit(total + ADDED * (distinct + 1)))
    rest = texts.select("mark", F.explode(F.arrays_zip("rest", "rest_n")).alias("t")).select("mark", F.col("t.rest").alias("h"), F.col("t.rest_n").alias("tf"))
    sums = (
        rest.join(counts.withColumnRenamed("n", "c"), "h", "left")
        .groupBy("mark")
        .agg(F.sum(F.col("tf") * log).alias("sum"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("known"))
    )
    rows = scored.groupBy("mark").agg(F.count("*").alias("rows"))
    per_text = sums.join(rows, "mark").select("mark", (F.col("sum") / F.col("rows")).alias("sum"), (F.col("known") / F.col("rows")).cast("long").alias("known"))
    return scored.join(per_text, "mark", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_frequent") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("frequent_score") + F.coalesce("sum", F.lit(0.0))).alias("base_score"),
        "score",
    )
