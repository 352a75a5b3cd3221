"""Licence scan: MinHash bands over overlapping text windows, verified by exact shingle containment.

Templates are grouped by size: class ``S`` holds those of at most ``S`` shingles.  For a class a text
is seen as windows of ``2S`` shingles, one every ``S``, so a template lies whole in some window.  The
signature of a window is its one-permutation MinHash: shingle hashes fall into bands by their top
bits, and the least hash of each band stands for it.  A band of a template collides with a window's
unless the window holds a smaller hash there, so with ``m`` shared shingles the chance to miss is at
most (S / bands) ** m; the number of bands is chosen so that this is 1e-4 or less for the smallest
template of the class at the threshold.  What collides is verified on the words themselves.

Everything is built from DataFrame functions and stays inside the row of a text; only matches are
shuffled.  Words are runs of letters and digits in lower case; a shingle is five words.

Edge cases: null and empty texts match nothing; templates with fewer words than a shingle are refused;
rows of one document id are reported together; null ids are reported as null; no templates, no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SHINGLE = 5
CONTAINMENT = 0.8
SMALLEST_CLASS = 16
CLASS_STEP = 4
MISS = 1e-4
#: Templates of up to so many words in all are broadcast; more are joined by a shuffle.
BROADCAST_WORDS = 50_000

# Public licence notices, as they appear in files and pages.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def notices(spark: SparkSession) -> DataFrame:
    """The built-in templates: template_id, text."""
    return spark.createDataFrame(list(NOTICES.items()), "template_id string, text string")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _hashes(words: Column) -> Column:
    count = F.size(words) - (SHINGLE - 1)
    return F.when(count >= 1, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*_run(words, i)))).otherwise(
        F.array().cast("array<bigint>")
    )


def _shingles(words: Column) -> Column:
    count = F.size(words) - (SHINGLE - 1)
    return F.array_distinct(F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.concat_ws(" ", *_run(words, i))))


def _run(words: Column, start: Column) -> list[Column]:
    """The words of a shingle by place; ``slice`` would copy the whole array each time."""
    return [F.get(words, start + k) for k in range(SHINGLE)]


def _stretch(array: str, start: Column, length: int) -> Column:
    """Up to ``length`` elements from ``start`` (from 1) on."""
    stop = F.least(start + (length - 1), F.size(array))
    return F.transform(F.sequence(start, stop), lambda i: F.get(array, i - 1))


def _signature(hashes: Column, band_bits: int) -> Column:
    """The least hash of every band that has one: in sorted order, each hash whose band differs from that before."""
    shift = 64 - band_bits
    none = F.array(F.lit(None).cast("long"))

    def firsts(ordered: Column) -> Column:
        # the one further element of the shifted array meets a null, which the filter removes
        kept = F.zip_with(ordered, F.concat(none, ordered), lambda h, p: F.when(p.isNull() | (F.shiftright(h, shift) != F.shiftright(p, shift)), h))
        return F.filter(kept, lambda h: h.isNotNull())

    return F.element_at(F.transform(F.array(F.sort_array(hashes)), firsts), 1)  # sorted once, used twice


def size_class(count: int) -> int:
    size = SMALLEST_CLASS
    while size < count:
        size *= CLASS_STEP
    return size


def band_bits(size: int, smallest: int, threshold: float = CONTAINMENT) -> int:
    """Bits that number the bands of a class, from the chance to miss its smallest template."""
    shared = max(1, -int(-threshold * smallest // 1))
    bits = 4
    while bits < 24 and (size / 2**bits) ** shared > MISS:
        bits += 1
    return bits


def scan(docs: DataFrame, templates: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """doc_id, template_id, containment (the best window's) and first_word (of the first matching window)."""
    known = templates.select("template_id", _words(F.col("text")).alias("words"))
    known = known.select("template_id", _shingles(F.col("words")).alias("wanted"), _hashes(F.col("words")).alias("hashes"), F.size("words").alias("n"))
    sizes = [(r.n_shingles, r.short) for r in known.select(F.size(F.array_distinct("hashes")).alias("n_shingles"), (F.col("n") < SHINGLE).alias("short")).distinct().collect()]
    if any(short for _, short in sizes):
        raise ValueError(f"a template needs {SHINGLE} words or more")
    classes: dict[int, int] = {}
    for count, _ in sizes:
        classes[size_class(count)] = min(count, classes.get(size_class(count), count))
    if not classes:
        return docs.select("doc_id", F.lit("").alias("template_id"), F.lit(0.0).alias("containment"), F.lit(0).alias("first_word")).where("false")
    bands = _template_bands(known, classes, threshold)
    if known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] <= BROADCAST_WORDS:
        bands = F.broadcast(bands)
    texts = docs.select("doc_id", _words(F.col("text")).alias("words"))
    texts = texts.select("doc_id", "words", _hashes(F.col("words")).alias("hashes"))
    windows = F.concat(*(_windows(size, band_bits(size, smallest, threshold)) for size, smallest in sorted(classes.items())))
    probes = texts.select("doc_id", F.explode(windows).alias("w")).select("doc_id", "w.size", "w.first_word", "w.words", F.explode("w.bands").alias("band"))
    pairs = probes.join(bands, ["size", "band"]).select("doc_id", "template_id", "first_word", "words", "wanted")
    share = F.size(F.array_intersect("wanted", _shingles(F.col("words")))) / F.size("wanted")
    found = pairs.select("doc_id", "template_id", "first_word", share.alias("containment")).where(F.col("containment") >= threshold)
    return found.groupBy("doc_id", "template_id").agg(F.max("containment").alias("containment"), F.min("first_word").alias("first_word"))


def _template_bands(known: DataFrame, classes: dict[int, int], threshold: float) -> DataFrame:
    """size, band, template_id and wanted shingles: one row for each band of each template."""
    distinct = F.array_distinct("hashes")
    size, bands = F.lit(None).cast("int"), F.lit(None).cast("array<bigint>")
    for at, smallest in sorted(classes.items(), reverse=True):
        size = F.when(F.size(distinct) <= at, F.lit(at)).otherwise(size)
        bands = F.when(F.size(distinct) <= at, _signature(distinct, band_bits(at, smallest, threshold))).otherwise(bands)
    return known.select(size.alias("size"), F.explode(bands).alias("band"), "template_id", "wanted")


def _windows(size: int, bits: int) -> Column:
    """The windows of one class, each with its size, first word, bands and words."""
    count = F.size("hashes")
    # the last window begins where it still adds shingles to the one before
    starts = F.when(count >= 1, F.sequence(F.lit(1), F.greatest(F.lit(1), count - size), F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda at: F.struct(
            F.lit(size).alias("size"),
            at.alias("first_word"),
            _signature(_stretch("hashes", at, 2 * size), bits).alias("bands"),
            _stretch("words", at, 2 * size + SHINGLE - 1).alias("words"),
        ),
    )
