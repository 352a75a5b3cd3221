"""Byte-level BPE encoding and decoding of whole texts, long ones by tree concatenation.

Texts of ordinary length are encoded where they lie.  A long text is cut into pieces that are
encoded in parallel, cut blindly, as unsplit text offers no safe place, and neighbouring results
are joined pairwise, halves to wholes.  At a join only a window is encoded again:

* Scanning for the tokenizer's splits starts at the last split of the left side that is certain
  and goes on through ever more splits of the right side until one of them is met; from there on
  both sides agree.
* If the part that crosses the join is one long unsplit run, the last tokens of the left and the
  first of the right are merged again in windows of growing size until the window begins with the
  left's own token and ends with the right's own.  A token sequence is the tokenizer's result if
  every two neighbours are, so both sides then agree exactly.

Encoding uses the tokenizers library.  Text between ASCII white space is encoded once per task and
remembered, as its split never depends on what surrounds it.

Edge cases: a null text is encoded as the empty one; ids may be null or repeat; strings of special
tokens are encoded as the special id, and no cut falls inside one.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemark.llm.shared import byte_letters, unused

#: Characters of a piece; longer texts are cut.
PIECE_CHARS = 1 << 15
CACHED_UNITS = 300_000
#: Tokens on either side of a join in the first window.
FIRST_WINDOW = 8

_UNIT = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
# white space beyond ASCII, or what some tables count as such: units next to it are not certain
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]")


class Codec:
    """One task's tokenizer: a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()) or self.tokenizer.normalizer is not None:
            raise ValueError("special tokens that take in white space, or a normaliser, are not covered")
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.longest_special = max(map(len, self.special), default=0)
        self.known: dict[str, bytes] = {}
        self.letters = byte_letters()
        self.lengths: np.ndarray | None = None

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """``encode`` for each text; units not met before are handed to the tokenizer together."""
        cut = [[t] if _ODD_SPACE.search(t) else _UNIT.findall(t) for t in texts]
        if len(self.known) > CACHED_UNITS:
            self.known = {}
        known, later = self.known, {}
        fresh = []
        for unit in set().union(*cut).difference(known):
            ids = self._plain(unit)
            if ids is None:
                fresh.append(unit)
            else:
                known[unit] = ids
        for at in range(0, len(fresh), 20_000):
            part = fresh[at : at + 20_000]
            for unit, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                (known if len(unit) <= 64 else later)[unit] = np.array(found.ids, "<u4").tobytes()
        if later:
            known = known | later
        return [b"".join(map(known.__getitem__, units)) for units in cut]

    def _plain(self, unit: str) -> bytes | None:
        """Ids of a unit of letters, perhaps after one space or line end and before marks: its splits are
        known, and only the merges are asked for.  None for any other unit."""
        body = unit.lstrip(" \n")
        core = body.rstrip(".,!?;:")
        lead = unit[: len(unit) - len(body)]
        if len(unit) > 64 or len(lead) > 1 or not core.isalpha():
            return None
        parts = [lead, core] if lead == "\n" else [lead + core]
        out = []
        for part in (*parts, body[len(core) :]):
            if part:
                mapped = part.encode().decode("latin-1").translate(self.letters)
                out += [t.id for t in self.tokenizer.model.tokenize(mapped)]
        return np.array(out, "<u4").tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def cuts(self, text: str, size: int) -> list[int]:
        """Ends of pieces of about ``size`` characters, never inside a special token."""
        out, at = [], size
        while at < len(text):
            begin = max(0, at - self.longest_special)
            for match in self.at_special.finditer(text, begin, at + self.longest_special):
                if match.start() < at < match.end():
                    at = match.end()
            out.append(at)
            at += size
        return [*(c for c in out if c < len(text)), len(text)]

    def splits(self, text: str) -> list[int]:
        """Ends of the parts that are merged separately."""
        out, at = [], 0
        for match in [*self.at_special.finditer(text), None]:
            stop = match.start() if match else len(text)
            if stop > at:
                out += [at + b for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text[at:stop]) if b > a]
            if match:
                out.append(match.end())
                at = match.end()
        return out

    def piece(self, text: str) -> "Block":
        ids = np.frombuffer(self.encode(text), "<u4")
        ends = self.splits(text)
        if self.lengths is None:
            size = self.tokenizer.get_vocab_size()
            self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        starts = [0, *ends[:-1]]
        byte_ends = np.cumsum([len(text[a:b].encode()) for a, b in zip(starts, ends)])
        upto = np.searchsorted(np.cumsum(self.lengths[ids]), byte_ends) + 1
        return Block(text, ids, np.array(ends, np.int64), upto.astype(np.int64))

    def merge_run(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Tokens of one unsplit run, from the tokens of its two parts."""
        if not len(left) or not len(right):
            return np.concatenate((left, right))
        size = FIRST_WINDOW
        name, model = self.tokenizer.id_to_token, self.tokenizer.model
        while True:
            a, b = left[-size:], right[:size]
            window = np.array([t.id for t in model.tokenize("".join(map(name, [*a.tolist(), *b.tolist()])))], "<u4")
            # a side that the window holds whole has nothing beyond it to agree with
            left_whole, right_whole = len(left) <= size, len(right) <= size
            if (left_whole or window[0] == a[0]) and (right_whole or window[-1] == b[-1]):
                return np.concatenate((left[: len(left) - len(a)], window, right[len(b) :]))
            size *= 2

    def join(self, a: "Block", b: "Block") -> "Block":
        if not a.text or not b.text:
            return a if a.text else b
        cut = len(a.text)
        # splits that end within three characters of the cut might have ended elsewhere, had they seen more
        certain = bisect_left(a.ends, cut - 2)
        first = int(a.ends[certain - 1]) if certain else 0
        kept = int(a.upto[certain - 1]) if certain else 0
        tail = a.text[first:]
        right_ends = b.ends
        look = 2
        while True:
            look = min(look, len(right_ends))
            reach = int(right_ends[look - 1])
            whole = look == len(right_ends)
            ends = self.splits(tail + b.text[:reach])
            # a split is certain when three more characters were seen behind it, or the text ends there
            for end in ends:
                at = end - len(tail)
                if at <= 0 or not (whole or reach - at >= 3):
                    continue
                k = bisect_left(right_ends, at)
                if k < len(right_ends) and right_ends[k] == at:
                    return self._joined(a, b, certain, first, kept, tail, ends[: ends.index(end) + 1], k)
            look *= 2

    def _joined(self, a: "Block", b: "Block", certain: int, first: int, kept: int, tail: str, ends: list[int], k: int) -> "Block":
        text, middle, upto, total, at = tail + b.text[: int(b.ends[k])], [], [], kept, 0
        for end in ends:
            part = text[at:end]
            if part in self.special:
                ids = np.array([self.special[part]], "<u4")
            elif k == 0 and len(ends) == 1 and certain == len(a.ends) - 1:  # one run crosses the join
                ids = self.merge_run(a.ids[kept:], b.ids[: int(b.upto[0])])
            else:
                mapped = "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part))
                ids = np.array([t.id for t in self.tokenizer.model.tokenize(mapped)], "<u4")
            middle.append(ids)
            total += len(ids)
            upto.append(total)
            at = end
        skipped = int(b.upto[k])
        return Block(
            a.text + b.text,
            np.concatenate((a.ids[:kept], *middle, b.ids[skipped:])),
            np.concatenate((a.ends[:certain], first + np.array(ends, np.int64), len(a.text) + b.ends[k + 1 :])),
            np.concatenate((a.upto[:certain], np.array(upto, np.int64), total - skipped + b.upto[k + 1 :])),
        )

    def tree(self, blocks: list["Block"]) -> "Block":
        """Join neighbours pairwise until one block is left."""
        while len(blocks) > 1:
            pairs = [self.join(*blocks[i : i + 2]) if i + 1 < len(blocks) else blocks[i] for i in range(0, len(blocks), 2)]
            blocks = pairs
        return blocks[0]


class Block:
    """A stretch of text with its ids, the ends of its splits and the number of tokens up to each."""

    def __init__(self, text: str, ids: np.ndarray, ends: np.ndarray, upto: np.ndarray):
        self.text, self.ids, self.ends, self.upto = text, ids, ends, upto




def _ids_of_short(path: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            others = [n for n in batch.schema.names if n != "text"]
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                encoded = codec.encode_many([t or "" for t in part.column("text").to_pylist()])
                yield _batch([part.column(n) for n in others], others, [_result(codec, e, digest) for e in encoded], digest)

    return run


def _result(codec: Codec, ids: bytes, digest: bool) -> tuple:
    if not digest:
        return len(ids) // 4, ids
    decoded = codec.decode(np.frombuffer(ids, "<u4"))
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def _batch(columns: list, names: list[str], rows: list[tuple], digest: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string()] if digest else [pa.int64(), pa.binary()]
    titles = ["n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["n_tokens", "ids"]
    values = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([*columns, *(pa.array(v, t) for v, t in zip(values, kinds))], [*names, *titles])


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), digest: bool = False, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``keep`` columns, n_tokens, and ids (unsigned 32-bit, little-endian) of every row's whole text.

    With ``digest`` the ids are decoded again and both come back as SHA-256 instead: ids_sha256 and
    decoded_sha256.  Texts of up to ``piece_chars`` characters never leave their task.  Columns of ``keep``
    that have the name of a result give way to it; other names cannot clash.
    """
    result = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "n_tokens long, ids binary"
    titles = [c.split()[0] for c in result.split(", ")]
    keep = tuple(c for c in keep if c not in titles)
    key = unused(docs)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    is_long = F.coalesce(F.length("text") > piece_chars, F.lit(False))
    short = source.where(~is_long).select(*keep, "text").mapInArrow(_ids_of_short(path, digest), f"{kinds}, {result}")

    # equal long texts are encoded once: copies join the result by the digest of the text
    long = source.where(is_long).withColumn(key, F.sha2(F.col("text").cast("binary"), 256))
    texts = long.select(F.col(key).alias("_key"), "text").dropDuplicates(["_key"])
    pieces = texts.mapInArrow(_cut(path, piece_chars), "_key string, number int, piece string")
    encoded = pieces.repartition(F.col("_key"), F.col("number")).mapInArrow(_pieces(path), "_key string, number int, piece string, ids binary, ends binary, upto binary")
    whole = encoded.groupBy("_key").applyInArrow(_tree(path, digest), f"_key string, {result}")
    joined = long.select(*keep, key).join(whole.withColumnRenamed("_key", key), key).select(*keep, *titles)
    return short.unionByName(joined)


def _cut(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            for key, text in zip(batch.column("_key").to_pylist(), batch.column("text").to_pylist()):
                ends = codec.cuts(text, size)
                parts = [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(parts)), pa.array(range(len(parts)), pa.int32()), pa.array(parts)], ["_key", "number", "piece"])

    return run


def _pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            blocks = [codec.piece(t) for t in batch.column("piece").to_pylist()]
            extra = [[b.ids.tobytes() for b in blocks], [b.ends.astype("<i4").tobytes() for b in blocks], [b.upto.astype("<i4").tobytes() for b in blocks]]
            names = ["_key", "number", "piece"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *(pa.array(e, pa.binary()) for e in extra)], [*names, "ids", "ends", "upto"])

    return run


def _tree(path: str, digest: bool):
    held: list[Codec] = []

    def run(group: pa.Table) -> pa.Table:
        if not held:
            held.append(Codec(path))
        codec = held[0]
        rows = sorted(group.select(["number", "piece", "ids", "ends", "upto"]).to_pylist(), key=lambda r: r["number"])
        number = lambda raw: np.frombuffer(raw, "<i4").astype(np.int64)
        whole = codec.tree([Block(r["piece"], np.frombuffer(r["ids"], "<u4"), number(r["ends"]), number(r["upto"])) for r in rows])
        out = _batch([pa.array([group.column("_key")[0].as_py()])], ["_key"], [_result(codec, whole.ids.astype("<u4").tobytes(), digest)], digest)
        return pa.Table.from_batches([out])

    return run
