"""Shared storage and small helpers of the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The six ASCII white-space characters that separate words, as a Java or RE2 character class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Most tasks that ``dealt`` asks for; beyond that a task takes several rows.
MAX_TASKS = 50_000


def folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); only a one-machine session may lack it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and (context := spark.sparkContext.getCheckpointDir()):
        configured = context
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="telemark-llm-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in shared storage."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to shared storage and go on from there: lost executors cost no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in shared storage that no later step reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished steps; it does so when the driver collects its garbage.

    The first round lets go of finished plans, the second of what only these held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def dealt(ranges: DataFrame, *keys: str) -> DataFrame:
    """Rows that each stand for much work, a task for each of them up to ``MAX_TASKS``.

    The number is given, as a shuffle of so few bytes would otherwise be coalesced into a single task.
    ``ranges`` is counted, so it should come from a written table.
    """
    return ranges.repartitionByRange(max(1, min(ranges.count(), MAX_TASKS)), *keys)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_mod(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; a null text has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE_CLASS}+"))


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes as, for ``str.translate`` on Latin-1 text:
    printable bytes stand for themselves, the others follow from 256 on in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + n) for n, b in enumerate(others)}


def unused(df: DataFrame, stem: str = "key") -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    return next(name for k in range(len(taken) + 1) if (name := f"_{stem}_{k}") not in taken)
