"""An index of the chunks of recordings, from which filtered scans are planned.

The index is three tables in one folder:

* ``chunks``: a row a chunk with its place, message count, time span, topics, the episode-wide number of its
  first message, and the split that it belongs to (consecutive chunks of a file up to ``split_bytes``);
* ``splits``: a row a split with its time span and topics;
* ``descriptions``: the schema and channel records of each file.

It is built in one pass: a task a file walks the record headers once (nine bytes a record), and the chunk
bodies are then read by as many tasks as there are chunks to share.  A scan with the index reads ``splits``
alone on the driver, whose rows are as many as the tasks to come, and each task reads its own chunks' rows.
No task walks headers, and filters on topic, episode and time pass over splits and chunks unread.

Edge cases: files without chunks have no rows; chunks without messages have a null time span and no topic,
and no filtered scan reads them; a message of a channel that its file never describes raises an error, as
in a plain scan.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark.functions.sequence import carry, track
from telemark.sources import mcap
from telemark.sources.durable import durable, scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PLACES = "episode string, path string, file_number bigint, at bigint, length bigint, header_bytes bigint"
_BODIES = (
    "episode string, path string, file_number bigint, at bigint, length bigint, header_bytes bigint, messages bigint, "
    "start_ns bigint, end_ns bigint, channels array<int>, codes array<int>, records array<binary>, crc bigint"
)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the chunks of whole files; ``header_bytes`` counts what was read since the last chunk."""
    for batch in batches:
        for row in batch.to_pylist():
            system, where = mcap.open_folder(row["path"])
            found, walked = [], 0
            with system.open_input_file(where) as handle:
                for code, at, length in mcap.outer_records(handle, row["path"], row["size"]):
                    walked += mcap.FRAME_BYTES
                    if code == mcap.CHUNK:
                        found.append((at, length, walked))
                        walked = 0
            columns = list(zip(*found, strict=True)) if found else [(), (), ()]
            same = [pa.array([row[c]] * len(found), kind) for c, kind in (("episode", pa.string()), ("path", pa.string()), ("file_number", pa.int64()))]
            yield pa.RecordBatch.from_arrays([*same, *(pa.array(c, pa.int64()) for c in columns)], ["episode", "path", "file_number", "at", "length", "header_bytes"])


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each chunk holds; one chunk is read at a time."""
    for batch in batches:
        handle, opened = None, None
        for k, row in enumerate(batch.to_pylist()):
            if row["path"] != opened:
                if handle is not None:
                    handle.close()
                system, where = mcap.open_folder(row["path"])
                handle, opened = system.open_input_file(where), row["path"]
            body, _, crc = mcap.chunk_body(handle, row["path"], row["at"], row["length"])
            layout = mcap.Layout(body)
            envelopes, _, _ = layout.envelopes()
            told = list(layout.descriptions())
            logged = envelopes["logged"]
            made = {
                "messages": pa.array([len(envelopes)], pa.int64()),
                "start_ns": pa.array([int(logged.min()) if len(logged) else None], pa.int64()),
                "end_ns": pa.array([int(logged.max()) if len(logged) else None], pa.int64()),
                "channels": pa.array([sorted(set(envelopes["channel"].tolist()))], pa.list_(pa.int32())),
                "codes": pa.array([[code for code, _ in told]], pa.list_(pa.int32())),
                "records": pa.array([[bytes(data) for _, data in told]], pa.list_(pa.binary())),
                "crc": pa.array([crc], pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, *made.values()], [*batch.schema.names, *made])
        if handle is not None:
            handle.close()


def _topics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Channel number and topic of each channel record."""
    for batch in batches:
        found = []
        for data in batch.column("data").to_pylist():
            cursor = mcap._Cursor(memoryview(data))
            number, _ = cursor.number("H"), cursor.number("H")
            found.append((number, cursor.text()))
        numbers, topics = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(numbers, pa.int32()), pa.array(topics, pa.string())], ["path", "channel", "topic"])


def build(spark: SparkSession, root: str, split_bytes: int = mcap.SPLIT_BYTES, folder: str | None = None) -> str:
    """Index all recordings below ``root``; returns the folder of the index."""
    folder = folder or scratch(spark, "chunk-index")
    files = spark.createDataFrame(mcap.find_episodes(root), "episode string, path string, file_number bigint, size bigint")
    places = durable(files.repartition("path").mapInArrow(_walk, _PLACES))
    bodies = durable(places.repartition("path", "at").sortWithinPartitions("path", "at").mapInArrow(_describe, _BODIES))
    described = bodies.select("path", "at", F.explode(F.arrays_zip("codes", "records")).alias("d"))
    described = described.select("path", "at", F.col("d.codes").alias("code"), F.col("d.records").alias("data"))
    described.repartitionByRange("path", "at").sortWithinPartitions("path", "at").write.parquet(f"{folder}/descriptions")

    names = described.filter(F.col("code") == mcap.CHANNEL).select("path", "data").mapInArrow(_topics, "path string, channel int, topic string").distinct()
    present = bodies.select("path", "at", F.explode("channels").alias("channel")).join(names, ["path", "channel"])
    topics = present.groupBy("path", "at").agg(F.sort_array(F.collect_set("topic")).alias("topics"))
    line = carry(track(bodies.drop("channels", "codes", "records"), ["episode"], ["file_number", "at"]), running={"_behind": F.col("messages")})
    line = line.rows().withColumn("first_record", F.col("_behind") - F.col("messages")).drop("_behind")
    line = carry(track(line, ["path"], ["at"]), running={"_bytes": F.col("length")}).rows()
    number = F.call_function("div", F.col("_bytes") - F.col("length"), F.lit(split_bytes).cast("bigint"))
    chunks = line.withColumn("split", number).drop("_bytes").join(topics, ["path", "at"], "left")
    chunks = chunks.withColumn("topics", F.coalesce("topics", F.array().cast("array<string>")))
    chunks.repartitionByRange("path", "split", "at").sortWithinPartitions("path", "split", "at").write.parquet(f"{folder}/chunks")

    written = spark.read.parquet(f"{folder}/chunks")
    splits = written.groupBy("episode", "path", "file_number", "split").agg(
        F.min("start_ns").alias("start_ns"), F.max("end_ns").alias("end_ns"),
        F.array_distinct(F.flatten(F.collect_set("topics"))).alias("topics"), F.sum("length").alias("bytes"), F.count("*").alias("chunks"),
    )
    splits.write.parquet(f"{folder}/splits")
    return folder


def scan(spark: SparkSession, root: str, index: str) -> DataFrame:
    """Messages with their episode-wide ``record_index``, read through the index.

    Conditions on ``topic``, ``episode`` and ``log_time_ns`` reach the source, which passes over splits and
    chunks that cannot hold a match.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(mcap.IndexedSource)
    raw = spark.read.format("mcap_indexed").option("index", index).option("tasks", 4 * spark.sparkContext.defaultParallelism).load(root)
    return raw.filter(F.col("ordinal").isNotNull()).drop("chunk_messages", "chunk_crc", "data_crc")
