"""Registered queries of the training-data operators, each over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemark.llm import bloom_lm, bpe, chat, classifier, contamination, infill, licences, negatives, packing, pagetext, rules, simhash, warc
from telemark.llm.shared import crc32_mod, scratch, table

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def may_learn(key: Column) -> Column:
    """Ids whose labels the classifier may see; the others are held out."""
    return crc32_mod(key, 3) != 1


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = rules.learn(docs, table(spark, sf_dir, "labels"))
    return rules.judge(docs, learned).drop("text")


def simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), digest=True)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = classifier.train(docs, table(spark, sf_dir, "labels"), may_learn(F.col("doc_id")))
    scored = classifier.score(docs, model)
    return scored.select(
        "doc_id",
        (~may_learn(F.col("doc_id"))).alias("held_out"),
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    found = warc.read(files, payload=False)
    return found.select(
        warc.page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_id("refers_to").alias("refers_to")
    )


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = packing.write(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=2)
    return packing.read(files, digest=True)


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), licences.notices(spark))


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(table(spark, sf_dir, "documents"), crc32_mod(F.col("doc_id"), 10) == 0)


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(table(spark, sf_dir, "pages"))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"))


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(table(spark, sf_dir, "documents"))
    digest = {"output_sha256": F.col("output"), "restored_sha256": infill.restored(F.col("output"), F.col("form"))}
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *(F.sha2(c.cast("binary"), 256).alias(name) for name, c in digest.items()))


QUERIES = {
    "op1_warc": warc_round_trip,
    "op2_quality_rules": quality_rules,
    "op3_simhash": simhash_components,
    "op4_byte_bpe": byte_bpe,
    "op5_token_files": token_files,
    "op6_decontamination": decontamination,
    "op7_licence_scan": licence_scan,
    "op8_language_model": language_model,
    "op9_chat_format": chat_format,
    "op10_quality_classifier": quality_classifier,
    "op11_page_text": page_text,
    "op12_hard_negatives": hard_negatives,
    "op13_fill_in_middle": fill_in_middle,
}

ORACLES = {
    "op6_decontamination": """
        WITH item_words AS (
            SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL
        ), item_shingles AS (
            SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words WHERE len(w) >= 5)
        ), sizes AS (
            SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id
        ), doc_words AS (
            SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL
        ), doc_shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc_words WHERE len(w) >= 5)
        ), shared AS (
            SELECT doc_id, item_id, count(*) AS n_shared FROM doc_shingles JOIN item_shingles USING (s) GROUP BY doc_id, item_id
        )
        SELECT doc_id, item_id, n_shared, n_item, n_shared::DOUBLE / n_item AS containment
        FROM shared JOIN sizes USING (item_id) WHERE n_shared >= 0.8 * n_item
    """,
    "op9_chat_format": """
        WITH turns AS (
            SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
        ), placed AS (
            SELECT conv_id, turn, role, text,
                   row_number() OVER w AS place,
                   string_agg(role || chr(1) || text || chr(2), '') OVER (w ROWS UNBOUNDED PRECEDING) AS so_far,
                   count(*) OVER (PARTITION BY conv_id) AS n_turns
            FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), alive AS (
            SELECT min(conv_id) AS conv_id FROM placed p
            WHERE place = n_turns AND NOT EXISTS (
                SELECT 1 FROM placed q WHERE q.so_far = p.so_far AND q.place < q.n_turns)
            GROUP BY so_far
        )
        SELECT conv_id, any_value(n_turns) AS n_turns, coalesce(CAST(floor(turn / 1024) AS BIGINT), -1) AS part,
               string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY place) AS rendered
        FROM placed JOIN alive USING (conv_id) GROUP BY conv_id, coalesce(CAST(floor(turn / 1024) AS BIGINT), -1)
    """,
    "op12_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
            FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN pairs USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5
    """,
    "op13_fill_in_middle": """
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents
        ), drawn AS (
            SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST(('0x' || substr(d, 1, 8)) AS UBIGINT) % (length(text) + 1) AS x,
                   CAST(('0x' || substr(d, 9, 8)) AS UBIGINT) % (length(text) + 1) AS y,
                   CAST(('0x' || substr(d, 17, 8)) AS UBIGINT) % 100 AS h3, CAST(('0x' || substr(d, 25, 8)) AS UBIGINT) % 100 AS h4
            FROM texts
        ), formed AS (
            SELECT doc_id, text, n, CAST(least(x, y) AS BIGINT) AS a, CAST(greatest(x, y) AS BIGINT) AS b,
                   CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
                        WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), pieces AS (
            SELECT *, substr(text, 1, a) AS p, substr(text, a + 1, b - a) AS m, substr(text, b + 1) AS s FROM formed
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM pieces
    """,
}
