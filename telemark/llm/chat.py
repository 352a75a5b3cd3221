"""Chat formatting: cumulative snapshots collapse into their longest form, which is rendered.

Logs often hold a conversation again after every turn.  Each turn gets the rolling hash of all turns
up to it (the exclusive or of the hashes of place, role and text, 128 bits).  A conversation whose
last hash is the hash of a further-going conversation at the same place is a prefix of it, and an
anti-join drops it.  Of equal conversations that with the smallest id stays.

Turns are numbered and hashed in buckets of 1,024 turns, and bucket totals are carried forward, so a
single conversation of any length is spread over tasks; rendered text comes in one part per bucket.

Edge cases: turns of one conversation are ordered by turn (nulls first), role and text; repeated rows
count once; a null conversation id is a conversation of its own; null role is ``unknown`` and null
text empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemark.llm.shared import durable

BUCKET_TURNS = 1024
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _carried(totals: DataFrame, value: Column) -> DataFrame:
    """(key, bucket) with ``before``: the totals of all earlier buckets together."""
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("key", "bucket", value.over(earlier).alias("before"))


def numbered(turns: DataFrame, bucket_turns: int = BUCKET_TURNS) -> DataFrame:
    """key, conv_id, bucket, place, role, text and the two halves of the prefix hash (a, b) of every turn."""
    rows = turns.select(
        F.struct(F.col("conv_id").isNull().alias("none"), "conv_id").alias("id"),
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    key = F.coalesce(F.concat(F.lit("="), F.col("id.conv_id").cast("string")), F.lit("none"))
    rows = rows.select(key.alias("key"), F.col("id.conv_id").alias("conv_id"), F.coalesce(F.floor(F.col("turn") / bucket_turns), F.lit(-1)).cast("long").alias("bucket"), "turn", "role", "text")
    inside = Window.partitionBy("key", "bucket").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    counted = rows.groupBy("key", "bucket").agg(F.count("*").alias("n"))
    places = _carried(counted, F.sum("n"))
    rows = rows.withColumn("place", F.row_number().over(inside)).join(places, ["key", "bucket"])
    rows = rows.withColumn("place", F.col("place") + F.coalesce("before", F.lit(0))).drop("before")
    rows = rows.withColumns({"a": F.xxhash64("place", "role", "text"), "b": F.xxhash64(F.lit("second"), "text", "role", "place")})
    sums = rows.groupBy("key", "bucket").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("key", "bucket", F.bit_xor("a").over(earlier).alias("a0"), F.bit_xor("b").over(earlier).alias("b0"))
    running = Window.partitionBy("key", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"a": F.bit_xor("a").over(running), "b": F.bit_xor("b").over(running)}).join(sums, ["key", "bucket"])
    zero = F.lit(0).cast("long")
    return rows.withColumns({"a": F.col("a").bitwiseXOR(F.coalesce("a0", zero)), "b": F.col("b").bitwiseXOR(F.coalesce("b0", zero))}).drop("a0", "b0")


def maximal(turns: DataFrame) -> DataFrame:
    """key and n_turns of the conversations that no other one continues, one of each set of equals."""
    length = turns.groupBy("key").agg(F.max("place").alias("n_turns"))
    marks = turns.select("key", "conv_id", "place", "a", "b").join(length, "key")
    # Equal conversations collapse before the anti-join, so both of its sides hold a hash once.
    best = F.min(F.struct(F.col("conv_id").isNull(), "conv_id", "key")).alias("best")
    whole = marks.where("place = n_turns").groupBy("n_turns", "a", "b").agg(best)
    inner = marks.where("place < n_turns").select(F.col("place").alias("n_turns"), "a", "b").distinct()
    first = whole.join(inner, ["n_turns", "a", "b"], "left_anti")
    return first.select(F.col("best.key").alias("key"), "n_turns")


def render(conversations: DataFrame, bucket_turns: int = BUCKET_TURNS) -> DataFrame:
    """conv_id, n_turns, part and rendered text of every maximal conversation of (conv_id, turn, role, text)."""
    turns = durable(numbered(conversations, bucket_turns), "turns")  # read three times below
    line = F.concat(F.lit(BEGIN), "role", F.lit("\n"), "text", F.lit(END + "\n"))
    chosen = turns.join(maximal(turns), "key").select("key", "conv_id", "n_turns", "bucket", F.struct("place", line.alias("line")).alias("t"))
    parts = chosen.groupBy("key", "conv_id", "n_turns", "bucket").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    text = F.concat_ws("", F.transform("ts", lambda t: t["line"]))
    return parts.select("conv_id", "n_turns", F.col("bucket").alias("part"), text.alias("rendered"))
