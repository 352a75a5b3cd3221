"""Fill-in-middle transformation of whole texts with pyarrow.compute.

A text of n units (code points) is cut twice; prefix, suffix and middle are put in the order of a form:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``: the text as it is

Cuts and form come from the SHA-256 of ``1:`` and the document's id, as built-in expressions.  The cutting
itself is one columnar pipeline a batch: texts become lists of units, the lists are flattened with the
index of their parent, each unit gets its ordinal, units are filtered by role, lists are rebuilt and
their units joined.  Texts are taken in parts of ``PART`` bytes at most (cut between code points; a part
counts on from the one before), so that the units of a long text are never held at once.

Edge cases: null and empty texts are plain and empty; texts that hold one of the three marks are plain;
a null id is hashed as the empty string; repeated rows give equal results; an empty table gives an empty
result.  Only ``doc_id`` and ``text`` are read: other columns of ``docs``, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
#: Of a hundred documents so many are rearranged, and of a hundred of these so many suffix first.
REARRANGED, SUFFIX_FIRST = 90, 20
#: Bytes of text whose units are held at once.
PART = 1 << 20


def _number(digest: Column, group: int) -> Column:
    """The eight hex digits of ``group`` (from 0) as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def plan(docs: DataFrame) -> DataFrame:
    """doc_id, text (never null), n, form, and the two cuts (null if plain)."""
    text = F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    marked = F.lit(False)
    for mark in MARKS.values():
        marked = marked | F.contains("text", F.lit(mark))
    drawn = docs.select("doc_id", text.alias("text")).withColumns(
        {"n": F.char_length("text").cast("long"), **{f"h{k + 1}": _number(digest, k) for k in range(4)}}
    )
    plain = (F.col("n") == 0) | marked | (F.col("h3") % 100 >= REARRANGED)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    a, b = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    return drawn.select(
        "doc_id", "text", "n", form.alias("form"),
        F.when(form != "plain", F.least(a, b)).alias("first"), F.when(form != "plain", F.greatest(a, b)).alias("second"),
    )


def _parts(texts: list[memoryview], size: int) -> Iterator[tuple[int, memoryview]]:
    """(place of the text, part) for parts of ``size`` bytes at most (four or more), cut between code points."""
    for place, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = min(at + size, len(text))
            while end < len(text) and end > at + 1 and text[end] & 0xC0 == 0x80:
                end -= 1
            yield place, text[at:end]
            at = end


def _groups(parts: Iterator[tuple[int, memoryview]], size: int) -> Iterator[list[tuple[int, memoryview]]]:
    held, total = [], 0
    for part in parts:
        if held and total + len(part[1]) > size:
            yield held
            held, total = [], 0
        held.append(part)
        total += len(part[1])
    if held:
        yield held


def _units(parts: list[memoryview]) -> pa.LargeListArray:
    """A list of code points, as UTF-8, for each part."""
    joined = np.frombuffer(b"".join(parts), np.uint8)
    starts = np.flatnonzero(joined & 0xC0 != 0x80).astype(np.int64)
    ends = np.cumsum([len(p) for p in parts])
    offsets = np.concatenate(([0], np.searchsorted(starts, ends))).astype(np.int64)
    edges = np.concatenate((starts, [len(joined)]))
    units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(joined)])
    return pa.LargeListArray.from_arrays(pa.array(offsets), units)


def _rebuilt(units: pa.Array, parents: pa.Array, lists: int) -> pa.Array:
    """The units of each parent joined; parents come in order."""
    counts = np.bincount(parents.to_numpy(), minlength=lists)
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int64))
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, units), pa.scalar(b"", pa.large_binary()))


def pieces(texts: list[memoryview], first: np.ndarray, second: np.ndarray, part: int = PART) -> dict[str, pa.Array]:
    """Prefix, middle and suffix of each text as binary arrays, cut at the ordinals ``first`` and ``second``."""
    found = {role: [] for role in MARKS}
    owners, seen = [], np.zeros(len(texts), np.int64)
    for group in _groups(_parts(texts, part), part):
        owner = np.array([place for place, _ in group], np.int64)
        lists = _units([p for _, p in group])
        units, parents = lists.flatten(), pc.list_parent_indices(lists)
        lengths = pc.list_value_length(lists).to_numpy()
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        # a part counts on from earlier groups and from earlier parts of its text in this one
        base = seen[owner] + starts - starts[np.searchsorted(owner, owner)]
        ordinals = pc.add(pa.array(np.arange(len(units))), pc.take(pa.array(base - starts), parents))
        np.add.at(seen, owner, lengths)
        in_prefix = pc.less(ordinals, pc.take(pa.array(first[owner]), parents))
        in_suffix = pc.greater_equal(ordinals, pc.take(pa.array(second[owner]), parents))
        roles = {"prefix": in_prefix, "suffix": in_suffix, "middle": pc.invert(pc.or_(in_prefix, in_suffix))}
        for role, mask in roles.items():
            found[role].append(_rebuilt(units.filter(mask), parents.filter(mask), len(group)))
        owners.append(owner)
    if not owners:
        return {role: pa.array([b""] * len(texts), pa.large_binary()) for role in MARKS}
    parents = pa.array(np.concatenate(owners))
    return {role: _rebuilt(pa.concat_arrays(arrays), parents, len(texts)) for role, arrays in found.items()}


def _rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``output`` column in place of ``text``; batches are cut so that little more than a part is held."""
    kinds = {role: pa.scalar(mark.encode(), pa.large_binary()) for role, mark in MARKS.items()}
    nothing = pa.scalar(b"", pa.large_binary())
    for whole in batches:
        sizes = np.cumsum(pc.binary_length(whole.column("text").cast(pa.large_binary())).to_numpy(zero_copy_only=False))
        cuts = np.flatnonzero(np.diff(sizes // PART, prepend=0)) if len(sizes) else np.empty(0, np.int64)
        edges = np.unique(np.concatenate(([0], cuts, [whole.num_rows])))
        for at, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            batch = whole.slice(at, end - at)
            text, form = batch.column("text").cast(pa.large_binary()), batch.column("form")
            cut = pc.not_equal(form, "plain")
            first, second = (pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False) for c in ("first", "second"))
            # plain texts pass through; of the others only the bytes are looked at
            own = [memoryview(t.as_buffer()) if c else memoryview(b"") for t, c in zip(text, cut.to_pylist())]
            piece = pieces(own, first, second)
            psm = pc.binary_join_element_wise(kinds["prefix"], piece["prefix"], kinds["suffix"], piece["suffix"], kinds["middle"], piece["middle"], nothing)
            spm = pc.binary_join_element_wise(kinds["suffix"], piece["suffix"], kinds["prefix"], piece["prefix"], kinds["middle"], piece["middle"], nothing)
            output = pc.if_else(cut, pc.if_else(pc.equal(form, "spm"), spm, psm), text).cast(pa.binary()).cast(pa.string())
            kept = ["doc_id", "n", "form", "first", "second"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), output], [*kept, "output"])


def transform(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the rearranged text as ``output``, a row for each of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = plan(docs).mapInArrow(_rearrange, f"doc_id {kind}, n long, form string, first long, second long, output string")
    return made.select("doc_id", "n", "form", F.col("first").alias("prefix_chars"), (F.col("second") - F.col("first")).alias("middle_chars"), "output")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of, from the output and its form alone."""
    pieces = F.split(output, "|".join(MARKS.values()), -1)  # no piece holds a mark
    prefix = F.when(form == "psm", pieces[1]).otherwise(pieces[2])
    suffix = F.when(form == "psm", pieces[2]).otherwise(pieces[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, pieces[3], suffix))
