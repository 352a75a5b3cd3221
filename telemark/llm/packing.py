"""Token-id files in Simple-8b, written in id order and read back in parts.

A file is a header, blocks, and a footer.  A block holds whole documents of 65,536 ids or more.  Its
ids are packed into 64-bit words: the top four bits select how many ids the other sixty hold, and of
what width.  A value of more than sixty bits is an escape: the word then holds the place of the full
value behind the block's words.  The footer has the place of each block and the length of each
document, so a task reads only the blocks it is given and unpacks each with one numpy step a selector.

Order: ids ascending, null ids first; rows of one id by the hash of their text.  Texts are spread by
ranges of (id, hash), so one repeated id does not fill a task.  A null text has the end id only.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from telemark.llm.files import NewFile, open_input
from telemark.llm.shared import dealt, byte_letters, durable, scratch

MAGIC = b"TMS8B\x00\x00\x01"
BLOCK_IDS = 1 << 16
FILE_WORDS = 8 << 20
SPLIT_BLOCKS = 32
CACHED_WORDS = 400_000
#: Width and number of ids of the selectors from 2 on; 0 stands for 240 zeros, 1 is the escape.
SHAPES = [(1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1)]
ZEROS, ESCAPE, FIRST = 0, 1, 2
RUN = 240
#: Largest id of each class: zero, then the widths of SHAPES.
_LIMITS = np.array([0, *((1 << bits) - 1 for bits, _ in SHAPES)], np.uint64)
_SPACE, _LETTER, _MARKS = (np.isin(np.arange(256), list(some)) for some in (b" \t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz", b".,!?;:*#$%&|"))


def pack(ids: np.ndarray) -> np.ndarray:
    """Words of ``ids`` (unsigned): each takes as many of the next ids as any selector allows."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64)
    # the first selector whose width holds an id; a run of RUN zeros has a class of its own
    need = np.searchsorted(_LIMITS, ids, "left").astype(np.uint8)
    widest = {1: need}
    size = 1
    while 2 * size <= RUN:
        low = widest[size]
        widest[2 * size] = np.maximum(low[:-size], low[size:]) if len(low) > size else low[:0]
        size *= 2

    def fits(count: int, most: int) -> np.ndarray:
        """Whether the ``count`` ids from each place on need class ``most`` at most."""
        out = np.zeros(n, bool)
        if count <= n:
            size = 1 << count.bit_length() - 1
            low = widest[size]
            out[: n - count + 1] = np.maximum(low[: n - count + 1], low[count - size : n - size + 1]) <= most
        return out

    take, chosen = np.ones(n, np.int64), np.full(n, ESCAPE, np.int64)
    for k in range(len(SHAPES) - 1, -1, -1):  # from few wide ids to many narrow ones: later choices hold more
        good = fits(SHAPES[k][1], k + 1)
        np.copyto(take, SHAPES[k][1], where=good)
        np.copyto(chosen, FIRST + k, where=good)
    good = fits(RUN, 0)
    np.copyto(take, RUN, where=good)
    np.copyto(chosen, ZEROS, where=good)
    following, starts, at = (take + np.arange(n)).tolist(), [], 0
    while at < n:
        starts.append(at)
        at = following[at]
    starts = np.array(starts, np.int64)
    selectors = chosen[starts]
    words = selectors.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate((ids, np.zeros(RUN, np.uint64)))
    for k, (bits, count) in enumerate(SHAPES):
        mine = np.flatnonzero(selectors == FIRST + k)
        if len(mine):
            values = padded[starts[mine][:, None] + np.arange(count)]
            words[mine] |= np.bitwise_or.reduce(values << (np.arange(count, dtype=np.uint64) * np.uint64(bits)), axis=1)
    escapes = np.flatnonzero(selectors == ESCAPE)
    words[escapes] |= np.arange(len(escapes), dtype=np.uint64)
    return np.concatenate((words, ids[starts[escapes]]))


def unpack(words: np.ndarray, n: int, n_escapes: int) -> np.ndarray:
    """The ``n`` ids of a block of which the last ``n_escapes`` words are full values."""
    main, full = words[: len(words) - n_escapes], words[len(words) - n_escapes :]
    selectors = (main >> np.uint64(60)).astype(np.int64)
    counts = np.array([RUN, 1, *(c for _, c in SHAPES)])[selectors]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for k, (bits, count) in enumerate(SHAPES):
        mine = np.flatnonzero(selectors == FIRST + k)
        if len(mine):
            mask = np.uint64((1 << bits) - 1)
            out[starts[mine][:, None] + np.arange(count)] = main[mine][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(bits)) & mask
    escapes = np.flatnonzero(selectors == ESCAPE)
    out[starts[escapes]] = full[(main[escapes] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out[:n]



class Writer:
    """One file: blocks as they fill up, then the footer."""

    def __init__(self, folder: str, stem: str):
        self.file = NewFile(folder, stem, ".s8b")
        self.file.write(MAGIC)
        self.blocks, self.docs, self.nulls, self.lengths = [], [], [], []
        self.waiting, self.held, self.words = [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            self._flush()

    def _flush(self) -> None:
        ids = np.concatenate(self.waiting).astype(np.uint64)
        words = pack(ids)
        first = len(self.docs) - len(self.waiting)
        self.blocks.append((len(MAGIC) + 8 * self.words, len(words), len(ids), int((ids >> np.uint64(60) != 0).sum()), first))
        self.file.write(words.astype("<u8").tobytes())
        self.words += len(words)
        self.waiting, self.held = [], 0

    def close(self) -> None:
        if self.waiting:
            self._flush()
        at = self.file.size
        for values, kind in ((self.blocks, "<i8"), (self.docs, "<i8"), (self.lengths, "<i8"), (self.nulls, "u1")):
            self.file.write(np.array(values, kind).tobytes())
        self.file.write(np.array([len(self.blocks), len(self.docs), at], "<i8").tobytes() + MAGIC)
        self.file.close()


def read_file(path: str, first: int, last: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, ids before it in the file, ids) of the documents in blocks ``first`` to ``last`` - 1."""
    with open_input(path) as source:
        size = source.size()
        source.seek(size - 32)
        tail = source.read(32)
        n_blocks, n_docs, at = np.frombuffer(tail[:24], "<i8").tolist()
        source.seek(0)
        if tail[24:] != MAGIC or source.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no token file")
        source.seek(at)
        footer = source.read(size - 32 - at)
        blocks = np.frombuffer(footer, "<i8", 5 * n_blocks).reshape(-1, 5)
        docs = np.frombuffer(footer, "<i8", n_docs, 40 * n_blocks)
        lengths = np.frombuffer(footer, "<i8", n_docs, 40 * n_blocks + 8 * n_docs)
        nulls = np.frombuffer(footer, "u1", n_docs, 40 * n_blocks + 16 * n_docs)
        starts = np.cumsum(lengths) - lengths
        stops = [*blocks[1:, 4].tolist(), n_docs]
        for k in range(first, last):
            offset, n_words, n_ids, n_escapes, doc = blocks[k].tolist()
            source.seek(offset)
            ids = unpack(np.frombuffer(source.read(8 * n_words), "<u8"), n_ids, n_escapes)
            base = int(starts[doc])
            for i in range(doc, stops[k]):
                begin = int(starts[i]) - base
                yield None if nulls[i] else int(docs[i]), int(starts[i]), ids[begin : begin + int(lengths[i])]


class Merges:
    """Byte-pair merges of many words at once.

    A word is a row of symbols.  In each round every word merges its pair of least rank, the leftmost
    among equals, until no word has a pair that merges.
    """

    NONE = np.iinfo(np.int32).max

    def __init__(self, first: np.ndarray, last: np.ndarray, pairs: np.ndarray, ranks: np.ndarray, made: np.ndarray):
        self.first, self.last, self.pairs, self.ranks, self.made = first, last, pairs, ranks, made

    @staticmethod
    def tables(path: str) -> tuple[np.ndarray, ...]:
        """Symbols of the bytes (inside a word, and at its end), and the merges sorted by pair."""
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("plain byte-pair merges are needed")
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        first = np.array([vocabulary.get(letters.get(b, chr(b)), -1) for b in range(256)], np.int64)
        last = np.array([vocabulary.get(letters.get(b, chr(b)) + suffix, -1) for b in range(256)], np.int64)
        split = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in split], np.int64)
        made = np.array([vocabulary[a + b] for a, b in split], np.int64)
        order = np.argsort(pairs, kind="stable")
        return first, last, pairs[order], order.astype(np.int32), made[order]

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of each pair (``NONE``: there is none), and its place in the tables."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where((self.pairs[at] == keys) & (right >= 0), self.ranks[at], self.NONE), at

    def _merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of ``words``, of like length, as bytes of unsigned 32-bit numbers."""
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        raw = np.frombuffer(b"".join(w.ljust(width) for w in words), np.uint8).reshape(-1, width)
        column = np.arange(width)
        ids = np.where(column < lengths[:, None] - 1, self.first[raw], np.where(column == lengths[:, None] - 1, self.last[raw], -1))
        ids = np.concatenate((ids, np.full((len(words), 1), -1)), 1)
        out = ids.copy()
        rank, place = self._find(ids[:, :-1], ids[:, 1:])
        rows = np.arange(len(words))
        while len(rows):
            at = rank.argmin(1)
            every = np.arange(len(rows))
            going = rank[every, at] < self.NONE
            if not going.all():
                out[rows[~going], : ids.shape[1]] = ids[~going]
                out[rows[~going], ids.shape[1] :] = -1
                rows, ids, rank, place, at = rows[going], ids[going], rank[going], place[going], at[going]
                every = every[: len(rows)]
                if not len(rows):
                    break
            made = self.made[place[every, at]]
            # what is behind the pair moves up by one
            column = np.arange(ids.shape[1] - 1)
            source = column + (column > at[:, None])
            ids = np.take_along_axis(ids, source, 1)
            ids[every, at] = made
            source = source[:, : rank.shape[1] - 1]
            rank, place = np.take_along_axis(rank, source, 1), np.take_along_axis(place, source, 1)
            if not rank.shape[1]:
                out[rows, : ids.shape[1]] = ids
                out[rows, ids.shape[1] :] = -1
                break
            for left in (at - 1, at):
                on = np.flatnonzero((left >= 0) & (left < rank.shape[1]))
                rank[on, left[on]], place[on, left[on]] = self._find(ids[on, left[on]], ids[on, left[on] + 1])
        counts = (out >= 0).sum(1)
        flat = out[out >= 0].astype("<u4").tobytes()
        ends = (4 * np.cumsum(counts)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def encode(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """(word, ids) of all words; words of like length are merged together."""
        by_size: dict[int, list[bytes]] = {}
        for word in words:
            by_size.setdefault(-(-len(word) // 4), []).append(word)
        for some in by_size.values():
            yield from zip(some, self._merge(some))


class Encoder:
    """The tokenizers library over words, each encoded once per task.

    The file's tokenizer drops white space and never looks across it, so words are independent.  Words of
    letters alone are one split: their byte-pair merges are made for all of them at once.
    """

    def __init__(self, path: str, end_id: int, merges: Merges):
        self.merges = merges
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.encode("a b", add_special_tokens=False).ids != [
            i for w in "ab" for i in self.tokenizer.encode(w, add_special_tokens=False).ids
        ]:
            raise ValueError("a tokenizer that drops white space is needed")
        self.end = np.array([end_id], "<u4").tobytes()
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of ``words``, as bytes; short words are kept for later."""
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        known, later = self.known, {}
        fresh, plain = [], []
        for word in words:
            if word in known:
                continue
            if len(word) <= 64 and word.isalpha() and word.islower():  # ASCII letters
                plain.append(word)
                continue
            letters = word.decode()
            normal = len(word) <= 64 and letters.isalpha() and letters == letters.lower() and unicodedata.is_normalized("NFC", letters)
            (plain if normal else fresh).append(word)
        known.update(self.merges.encode(plain))
        for at in range(0, len(fresh), 20_000):
            part = fresh[at : at + 20_000]
            for word, found in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                (known if len(word) <= 64 else later)[word] = np.array(found.ids, "<u4").tobytes()
        return known | later if later else known

    def encode_many(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of each text, with the end id.

        Words are told apart by columns of bytes: white space parts them, and the tokenizer always splits
        between a letter and a mark behind it.  Equal words of the texts are encoded once.
        """
        texts = [t or b"" for t in texts]
        # perhaps a special token, which is matched before any change of case
        special = {k: t.split() for k, t in enumerate(texts) if b"<|" in t}
        lowered = [b"" if k in special else t.lower() for k, t in enumerate(texts)]
        raw = np.frombuffer(b"\n".join([*lowered, b""]), np.uint8)
        letter = ~_SPACE[raw]
        begins = letter.copy()
        begins[1:] &= _SPACE[raw[:-1]] | (_LETTER[raw[:-1]] & _MARKS[raw[1:]])
        starts = np.flatnonzero(begins)
        packed = raw[letter]
        offsets = np.append((np.cumsum(letter) - letter)[starts], len(packed)).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        known = self._learn([*distinct, *{w for ws in special.values() for w in ws}])
        parts = [*map(known.__getitem__, distinct), self.end]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), "<u4")
        ends = np.cumsum([len(t) + 1 for t in lowered])
        stops = np.searchsorted(starts, ends)  # words of all texts so far
        codes = np.insert(words.indices.to_numpy().astype(np.int64), stops, len(distinct))
        counts = sizes[codes]
        behind = np.cumsum(counts)
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[codes] - (behind - counts), counts) + np.arange(behind[-1] if len(behind) else 0)]
        last = behind[stops + np.arange(len(stops))]
        out = np.split(ids, last[:-1]) if len(texts) else []
        for k, own in special.items():
            out[k] = np.frombuffer(b"".join([*map(known.__getitem__, own), self.end]), "<u4")
        return out


def write(docs: DataFrame, path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode and write ``docs`` (doc_id, text); returns the files in order: part, number, path, n_ids, n_blocks."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    tables = spark.sparkContext.broadcast(Merges.tables(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, encoder = TaskContext.get().partitionId(), 0, None, Encoder(path, end_id, Merges(*tables.value))

        def finished() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([out.file.path]), pa.array([sum(out.lengths)], pa.int64()), pa.array([len(out.blocks)], pa.int32())],
                ["part", "number", "path", "n_ids", "n_blocks"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), encoder.encode_many(some.column("text").cast(pa.binary()).to_pylist())):
                    if out is None:
                        out = Writer(folder, f"part-{part:06d}-{number:04d}")
                    out.add(doc_id, ids)
                    if out.words >= FILE_WORDS:
                        yield finished()
                        number, out = number + 1, None
        if out is not None:
            yield finished()

    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie")]
    ranged = docs.select("doc_id", "text", F.xxhash64("text").alias("_tie")).repartitionByRange(*order).sortWithinPartitions(*order)
    return durable(ranged.select("doc_id", "text").mapInArrow(run, "part int, number int, path string, n_ids long, n_blocks int"), "token-files")


def read(files: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids, or with ``digest`` ids_crc32."""
    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    based = files.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    splits = based.select(
        "path", "base", "n_blocks", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1, F.lit(SPLIT_BLOCKS))).alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 4
            last = ("ids_crc32", pa.int64()) if digest else ("ids", pa.list_(pa.int64()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), last[1]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "n_tokens", last[0]])

        for batch in batches:
            for path, base, n_blocks, first in zip(*(batch.column(c).to_pylist() for c in ("path", "base", "n_blocks", "first"))):
                rows, held = [], 0
                for doc_id, start, ids in read_file(path, first, min(first + SPLIT_BLOCKS, n_blocks)):
                    rows.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.astype(np.int64)))
                    held += 1 if digest else len(ids)
                    if held >= 1 << 20:
                        yield table(rows)
                        rows, held = [], 0
                yield table(rows)

    last = "ids_crc32 long" if digest else "ids array<long>"
    return dealt(splits, "path", "first").mapInArrow(run, f"doc_id long, start long, n_tokens long, {last}")
