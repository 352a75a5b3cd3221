"""Training-data operators against brute force, on small tables with the awkward cases."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telemark.llm import bloom_lm, bpe, chat, classifier, contamination, licences, nearcopies, packing, rules, simhash, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return (text or "").encode().split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abdegilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = prose(1, 300)
    out = [(k, prose(100 + k, 40 + 7 * k)) for k in range(12)]
    out += [(20, base), (21, base), (22, base.replace(" ", "\n", 3)), (23, base + " end"), (24, None), (25, ""), (26, " \t\n"), (27, "one two"), (28, "x" * 90_000)]
    out += [(None, base), (5, out[5][1]), (29, "a b c d e " * 60), (30, "Same line.\nSame line.\n\nother ### $$$ |"), (31, prose(3, 9000))]
    return [(k, t, "en", "src0", len(t or "")) for k, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_statistics(text):
    w = [x.decode() for x in words(text)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics(docs, rows):
    got = rules.judge(docs, []).select("text", *rules.COUNTS, "base_failed", "kept").collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_statistics(r.text)
        assert tuple(r)[1:6] == want, r.text[:80]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r.kept is not r.base_failed


def test_rules_are_learned_and_applied_in_order(spark):
    r = random.Random(2)
    rows = [(k, " ".join(w + ("###" if k % 4 == 0 and r.random() < 0.8 else "") for w in prose(k, 60).split())) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 != 0), 0) for k in range(240)] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    learned = rules.learn(docs, labels)
    assert learned and all(rule.terms for rule in learned)
    kept = {x.doc_id for x in rules.judge(docs, learned).where("kept").collect()}
    assert kept == {k for k in range(240) if k % 4}
    assert rules.learn(docs, labels.where("false")) == []


def test_no_python_on_the_native_path(spark, docs):
    for plan in (rules.judge(docs, []), licences.scan(docs, licences.notices(spark))):
        assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().optimizedPlan().toString())


def brute_fingerprint(text):
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs):
    parent = {f: f for _, f in pairs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    prints = sorted(parent)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    ids = {}
    for k, f in pairs:
        if k is not None:
            ids[find(f)] = min(k, ids.get(find(f), k))
    return [(k, f, ids.get(find(f))) for k, f in pairs]


def test_simhash_components(docs, rows, empty):
    got = [(r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    want = brute_components([(r[0], brute_fingerprint(r[1])) for r in rows])
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})


def test_anchors_meet_every_close_pair():
    r = np.random.default_rng(4)
    x = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    y = x.copy()
    for _ in range(2):
        y ^= np.uint64(1) << r.integers(0, 64, len(x)).astype(np.uint64)
    met = []
    for values in (x, y):
        row, anchor = simhash.anchors(values.view(np.int64))
        met.append([set() for _ in values])
        for i, a in zip(row.tolist(), anchor.tolist()):
            met[-1][i].add(a)
    assert all(a & b for a, b in zip(*met)) and max(map(len, met[0])) <= 33


def test_chains_become_one_component(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(101, 100)], "a long, b long")
    assert {(r.node, r.root) for r in simhash.components(links).collect()} == {(k, 0) for k in range(1, 41)} | {(101, 100)}


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_byte_bpe(docs, rows, byte_tokenizer, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(docs, path, digest=True, piece_chars=500).collect())
    want = Counter()
    for k, t, *_ in rows:
        ids = byte_tokenizer.encode(t or "", add_special_tokens=False).ids
        decoded = byte_tokenizer.decode(ids, skip_special_tokens=False)
        want[(k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())] += 1
    assert got == want
    assert bpe.encode(empty, path).count() == 0


def test_tree_concatenation(byte_tokenizer):
    codec, r = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json")), random.Random(7)
    parts = ["a", "the", " ", "  ", "\n", "'s", "'ll", "!", "12", "é", "漢字", " ", "\x1c", "<|endoftext|>", "ing", "😀"]
    for _ in range(1500):
        some = r.sample(parts, r.choice([2, 4, 8]))
        text = "".join(r.choice(some) for _ in range(r.choice([3, 20, 60])))
        ends = codec.cuts(text, r.choice([1, 2, 5, 11]))
        whole = codec.tree([codec.piece(text[a:b]) for a, b in zip([0, *ends[:-1]], ends)])
        assert whole.ids.tolist() == byte_tokenizer.encode(text, add_special_tokens=False).ids, text


def test_simple8b_packs_any_ids():
    r = np.random.default_rng(3)
    for ids in (
        np.zeros(1000, np.uint64), r.integers(0, 49_408, 5000).astype(np.uint64), np.array([1 << 60, 0, (1 << 64) - 1, 5], np.uint64),
        np.array([7], np.uint64), r.integers(0, 2, 777).astype(np.uint64), (np.uint64(1) << r.integers(0, 64, 3000).astype(np.uint64)),
    ):
        assert (packing.unpack(packing.pack(ids), len(ids), int((ids >> np.uint64(60) != 0).sum())) == ids).all()


def test_token_files(docs, rows, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.read(packing.write(docs, path, 2)).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    texts = {r[0]: r[1] for r in rows}
    start = 0
    for r in got:
        want = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids) == (start, len(want), want)
        start += len(want)
    digests = {r.doc_id: r.ids_crc32 for r in packing.read(packing.write(docs, path, 2), digest=True).collect()}
    assert digests[24] == zlib.crc32(np.array([2], "<u4").tobytes())
    assert packing.read(packing.write(empty, path, 2)).count() == 0


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "é" * 5000), (4, "http://a/4\r\nx", None), (5, "u", ""), (None, "u", "none"), (2, "u", "same"), (None, "u", "same")]
    pages += [(10 + k, f"http://b/{k}", prose(k, 300)) for k in range(40)]
    files = warc.write(spark.createDataFrame(pages, "page_id long, url string, html string"), str(tmp_path / "w"), file_bytes=9000)
    for split_bytes in (64, 1000, 1 << 20):  # records start anywhere in a range
        found = warc.read(files, split_bytes=split_bytes).select("*", warc.page_id("record_id").alias("page"), warc.page_id("refers_to").alias("to")).collect()
        assert len(found) == len(pages)
        got = Counter((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.to) for r in found)
        largest = {}
        for k, _, html in pages:
            if k is not None:
                largest[html or ""] = max(k, largest.get(html or "", k))
        want = Counter()
        for k, _, html in pages:
            raw = (html or "").encode()
            to = largest.get(html or "")
            to = None if to == k else to
            want[(k, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if to is None else "revisit", to)] += 1
        assert got == want
        assert {r.payload.decode() for r in found if r.record_type == "response"} == {p[2] or "" for p in pages}
    nothing = warc.write(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "none"))
    assert warc.read(nothing).count() == 0


def test_contamination(spark, docs, rows, empty):
    texts = {r[0]: r[1] for r in rows}
    items = [(1, " ".join(texts[31].split()[500:540])), (2, prose(900, 30)), (3, "too short here"), (4, None), (5, " ".join(texts[20].split()[100:160]).upper() + "!")]
    items.append((6, " ".join(texts[31].split()[700:740][:36] + ["zz"] * 4)))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in contamination.contaminated(docs, table, block_chars=300).collect())
    want = Counter()
    for k, text, *_ in rows:
        w = contamination.split(text)
        own = {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}
        for item, t in items:
            v = contamination.split(t)
            s = {" ".join(v[i : i + 5]) for i in range(len(v) - 4)}
            if s and len(s & own) >= 0.8 * len(s):
                want[(k, item, len(s & own), len(s))] += 1
    assert got == want and len(want) >= 5
    kept = contamination.clean(docs, table)
    assert kept.count() == len(rows) - sum(any(k == r[0] for k, *_ in want) for r in rows)
    assert contamination.contaminated(docs, table.where("false")).count() == 0 and contamination.contaminated(empty, table).count() == 0


def test_licences(spark, empty):
    long = prose(5, 400).split()
    texts = [
        (1, "Released under the MIT License."), (2, " ".join([*long[:33], "licensed UNDER the Apache License, Version 2.0.", *long[33:]])),
        (3, " ".join(long)), (4, None), (5, ""), (6, "This work is licensed under the GNU General Public License, version 2"), (None, "Released under the MIT License"),
    ]
    for at in range(60):  # wherever a notice lies, a window holds it
        texts.append((100 + at, " ".join([*long[: 90 + at], licences.NOTICES["MIT-text"], *long[90 + at :]])))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.doc_id, r.template_id) for r in licences.scan(docs, licences.notices(spark)).collect()}
    assert got == {(1, "MIT"), (2, "Apache-2.0"), (6, "GPL-3.0"), (None, "MIT")} | {(100 + k, "MIT-text") for k in range(60)}
    assert licences.scan(empty, licences.notices(spark)).count() == 0
    assert licences.scan(docs, licences.notices(spark).where("false")).count() == 0


def test_language_model(docs, rows, empty):
    got = bloom_lm.score(docs, F.col("doc_id") == 3).collect()
    tokens = lambda t: [*(w.lower() for w in words(t)), None]
    counts = Counter(x for r in rows if r[0] is not None and r[0] != 3 for x in tokens(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    assert len(got) == sum(r[0] is not None for r in rows) + 1
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        own = tokens(texts[r.doc_id])
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[x] > 0 for x in own), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score <= 0
    assert bloom_lm.score(empty, F.lit(False)).count() == 0


def test_bloom_levels_hold_counts():
    keys = bloom_lm.mix(np.arange(1, 2001, dtype=np.uint64))
    counts = np.arange(1, 2001)
    bits = np.zeros(bloom_lm.SEGMENTS * 4096, np.uint8)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["h", "n"])
    for part in bloom_lm._segments(8 * 4096)(iter([batch])):
        at = part.column("segment")[0].as_py() * 4096
        bits[at : at + 4096] |= np.frombuffer(part.column("bits")[0].as_py(), np.uint8)
    keys &= bloom_lm.KEPT
    found, want = bloom_lm.levels_of(keys, bits, bloom_lm.segment_of(keys), 8 * 4096), bloom_lm.level(counts)
    assert (found >= want).all() and (found == want).mean() > 0.9
    assert (want <= counts).all() and want[:4].tolist() == [1, 2, 3, 4] and bloom_lm.level(np.array([2**62])) <= bloom_lm.MAX_LEVEL


def test_chat(spark):
    turns = [
        ("a", 0, "user", "hi"), ("a", 1, "assistant", "yo"), ("b", 0, "user", "hi"), ("c", 0, "user", "hi"), ("c", 1, "assistant", "yo"), ("c", 2, "user", "more"),
        ("d", 0, "user", "other"), ("e", 0, "user", "other"), ("f", 0, None, None), (None, 0, "user", "lost"), ("c", 2, "user", "more"), ("g", 0, "assistant", "hi"),
    ]
    turns += [("long", k, "user", f"t{k}") for k in range(9)] + [("cut", k, "user", f"t{k}") for k in range(5)]
    table = spark.createDataFrame(turns, "conv_id string, turn int, role string, text string")
    got = chat.render(table, bucket_turns=2).collect()
    assert {(r.conv_id, r.n_turns) for r in got} == {("c", 3), ("d", 1), ("f", 1), (None, 1), ("g", 1), ("long", 9)}
    text = "".join(r.rendered for r in sorted((r for r in got if r.conv_id == "long"), key=lambda r: r.part))
    assert text == "".join(f"<|im_start|>user\nt{k}<|im_end|>\n" for k in range(9))
    assert chat.render(table.where("false")).count() == 0
    odd = spark.createDataFrame([(None, 0, "user", "x"), ("\0", 0, "user", "y"), ("none", 0, "user", "z")], table.schema)
    assert {(r.conv_id, r.n_turns) for r in chat.render(odd).collect()} == {(None, 1), ("\0", 1), ("none", 1)}


def test_classifier(spark, empty):
    rows = [(k, prose(k, 50) if k % 3 else prose(k, 50).upper()) for k in range(150)] + [(500, None), (501, ""), (None, "some text"), (502, "y" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 != 0), 0) for k in range(150)] + [(900, 1, 0)], "doc_id long, quality int, toxic int")
    model = classifier.train(docs, labels, F.col("doc_id") % 5 != 0)
    scores = {r.doc_id: r._score for r in classifier.score(docs, model).collect()}
    assert len(scores) == len(rows) and all(0 <= s <= 1 for s in scores.values())
    held = [k for k in range(150) if k % 5 == 0]
    assert sum((scores[k] >= 0.5) == (k % 3 != 0) for k in held) / len(held) >= 0.9
    assert classifier.score(empty, classifier.train(docs, labels.where("false"))).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, folder)
        assert after.columns == docs.columns, name
        assert not Counter(after.collect()) - Counter(before.collect()), name
        after.write.parquet(str(tmp_path / name.replace(" ", "-")))
        before = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
    assert 0 < before.count() < docs.count()
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, folder).collect()) == Counter(r.doc_id for r in before.collect())


def brute_near_copies(rows, similarity=0.8):
    """Sets of ids that hang together by exact Jaccard similarity of five-word shingles."""
    sets = []
    for k, t in rows:
        w = words((t or "").lower())
        sets.append((k, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    group = {k: {k} for k, _ in rows}
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if (x == y or len(x & y) / len(x | y) >= similarity) and group[a] is not group[b]:
                group[a] |= group[b]
                for k in group[b]:
                    group[k] = group[a]
    return {frozenset(g) for g in group.values()}


def near_rows():
    """Texts with one to twelve changed words, chains of copies, and the awkward cases."""
    r, out = random.Random(3), []
    for base in range(60):
        w = prose(1000 + base, 200).split()
        out.append(" ".join(w))
        for _ in range(3):
            for at in r.sample(range(200), r.randint(1, 6)):
                w[at] = f"changed{r.randrange(10**6)}"
            out.append(" ".join(w))
    out += [None, "", " \n", "one two", "One  two", "one three", prose(1, 6), prose(1, 6) + " end", prose(2, 9000), prose(2, 9000) + " more"]
    return list(enumerate(out))


def test_near_copies(spark, empty):
    rows = near_rows()
    table = spark.createDataFrame([(k, t, "en", "src0", 0) for k, t in rows], DOCS)
    want = brute_near_copies(rows)
    assert len(want) < len(rows) - 60  # links that the two bits of op3 do not see
    for block in (nearcopies.BLOCK_SHINGLES, 300):
        groups = {}
        for r in nearcopies.near_copies(table, block_shingles=block).collect():
            groups.setdefault(bytes(r.group), set()).add(r.doc_id)
        assert {frozenset(g) for g in groups.values()} == want
    import corpus_pipeline

    kept = corpus_pipeline.near_duplicates(spark, table, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(map(min, want))
    assert corpus_pipeline.near_duplicates(spark, empty, "").count() == 0


def test_near_copies_meet_by_simhash(spark, monkeypatch):
    """The stage takes the components of SimHash as proposals, and the exact sets decide about them."""
    import corpus_pipeline

    rows = near_rows()
    table = spark.createDataFrame([(k, t, "en", "src0", 0) for k, t in rows], DOCS)
    want = sorted(map(min, brute_near_copies(rows)))
    asked = []

    def one_group(distinct):
        asked.append({r.fingerprint % (1 << 64) for r in distinct.collect()})
        return distinct.withColumn("group", F.lit(7).cast("long"))

    monkeypatch.setattr(nearcopies, "groups", one_group)  # as if all texts had met
    kept = corpus_pipeline.near_duplicates(spark, table, "")
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert asked == [{simhash.fingerprint((t or "").encode()) for _, t in rows}]


def test_pipeline_classifier_rejects(spark, tmp_path):
    import corpus_pipeline

    rows = [(k, prose(k, 50) if k % 3 else prose(k, 50).upper(), "en", "src0", 0) for k in range(240)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, int(k % 3 != 0), 0) for k in range(180)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    # the rules have kept all good documents, and of the bad ones only some without a label
    given = docs.where("doc_id % 3 != 0 or doc_id >= 180")
    kept = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, given, str(tmp_path)).collect()}
    bad, good = {k for k in range(180, 240) if k % 3 == 0}, {k for k in range(240) if k % 3}
    assert len(kept & bad) <= 1 and len(kept & good) >= 0.95 * len(good)


def test_language_model_score_at_any_size(spark):
    """Scores of a filter of many segments against exact counts, and bits for every entry at 30 GB."""
    rows = [(k, prose(k % 40, 30) + " " + prose(500 + k, 20)) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learned = [[*t.split(), None] for k, t in rows if k % 10]
    counts = Counter(w for t in learned for w in t)
    pairs = Counter(p for t in learned for p in zip(["start", *t], t))
    total, distinct = sum(counts.values()), len(counts)
    value = lambda n: float(bloom_lm.level_value(bloom_lm.level(np.array([n])))[0]) if n else 0.0
    # 256 bits a segment make blocks of 64 segments; frames of 37 tokens cut most texts
    got = {r.doc_id: r.score for r in bloom_lm.score(docs, F.col("doc_id") % 10 == 0, segment_bits=1 << 8, frame=37).collect()}
    assert bloom_lm.layout(total + distinct, 1 << 8)[0] > bloom_lm.SEGMENTS and len(got) == len(rows)
    off = []
    for k, t in rows:
        want, own = 0.0, [*t.split(), None]
        for u, w in zip(["start", *own], own):
            n = value(counts[None if u == "start" else u])
            alone = (value(counts[w]) + 0.1) / (total + 0.1 * (distinct + 1))
            want += math.log10((min(value(pairs[u, w]), n) + 4 * alone) / (n + 4))
        off.append(abs(got[k] - want) / abs(want))
    assert np.mean(off) < 0.1
    for entries in (10**3, 10**8, 8 * 10**9):
        segments, bits = bloom_lm.layout(entries)
        assert segments * bits >= bloom_lm.BITS_PER_ENTRY * entries and bits <= bloom_lm.SEGMENT_BITS


def test_contamination_finds_the_shortest_items(spark):
    items = [(k, prose(7000 + k, 5 + k % 2)) for k in range(200)]
    texts = [(k, " ".join([prose(8000 + k, 100 + k), t, prose(9000 + k, 220 - k)])) for k, t in items]
    found = contamination.contaminated(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(k, k) for k, _ in items}


def test_counts_travel_by_segment(monkeypatch):
    """A row for each segment, not for each pair; what is built from them has the bits of every count."""
    texts = [prose(9000 + k, 40).encode() for k in range(300)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    plain = pa.Table.from_batches(bloom_lm._counter(True)([batch]))
    keys, counts = plain.column("h").to_numpy().view(np.uint64), plain.column("n").to_numpy()
    segments, bits = 300, 1 << 12
    rows = pa.Table.from_batches(bloom_lm._counter(True, bloom_lm._by_segment(segments))([batch]))
    owner = bloom_lm.segment_of(keys, segments)
    assert rows.num_rows == len(np.unique(owner)) < len(keys)
    for number, h, n in zip(*(rows.column(c).to_pylist() for c in ("segment", "h", "n"))):
        assert np.frombuffer(h, np.uint64).tolist() == keys[owner == number].tolist()
        assert np.frombuffer(n, np.int64).tolist() == counts[owner == number].tolist()
    # counts of two tasks are summed before levels are taken
    built = bloom_lm._segments(bits, segments)([*rows.to_batches(), *bloom_lm._packer(segments)(plain.to_batches())])
    whole = np.zeros(segments * bits // 8, np.uint8)
    for part in built:
        at = part.column("segment")[0].as_py() * bits // 8
        whole[at : at + bits // 8] = np.frombuffer(part.column("bits")[0].as_py(), np.uint8)
    keys = keys & bloom_lm.KEPT
    for q in range(1, bloom_lm.level(2 * counts).max() + 1):
        for place in bloom_lm.places(keys[bloom_lm.level(2 * counts) >= q], q, bits):
            at = bloom_lm.segment_of(keys[bloom_lm.level(2 * counts) >= q], segments).astype(np.uint64) * np.uint64(bits) + place
            assert (whole[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all()
    # blocks of any size change nothing
    found, tokens = bloom_lm.levels_of(keys, whole, owner, bits), bloom_lm.tokens(texts)
    monkeypatch.setattr(bloom_lm, "BLOCK_KEYS", 7)
    monkeypatch.setattr(bloom_lm, "BLOCK_BYTES", 50)
    assert (found >= bloom_lm.level(2 * counts)).all() and (bloom_lm.levels_of(keys, whole, owner, bits) == found).all()
    assert all((a == b).all() for a, b in zip(bloom_lm.tokens(texts), tokens))
    assert bloom_lm.tokens([None, b"", b" "])[1].tolist() == [0, 1, 2, 3]
