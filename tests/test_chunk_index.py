"""The chunk index: what it holds, what a filtered scan reads, and that nothing is lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

from telemark import contract
from telemark.sources import chunk_index, mcap
from tests.conftest import ORIGIN, SECOND

COLUMNS = ["episode", "record_index", "topic", "header_time_ns", "log_time_ns", "cdr_file_offset", "sequence"]


@pytest.fixture(scope="module")
def index(spark, recordings):
    return chunk_index.build(spark, recordings, split_bytes=9000)


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def chunks_read(recordings, index, *filters):
    """Chunks that a reader with these conditions loads."""
    reader = mcap.IndexedReader({"path": recordings, "index": index})
    assert list(reader.pushFilters(list(filters))) == []  # all are taken over
    loaded = []
    with pytest.MonkeyPatch.context() as patch:
        plain = mcap.chunk_body
        patch.setattr(mcap, "chunk_body", lambda *a: loaded.append(a[2]) or plain(*a))
        for part in reader.partitions():
            list(reader.read(part))
    return len(loaded)


def test_headers_are_read_once(spark, recordings, index):
    found = spark.read.parquet(f"{index}/chunks")
    records = 0
    for _, path, _, size in mcap.find_episodes(recordings):
        with open(path, "rb") as handle:
            records += sum(1 for code, _, _ in mcap.outer_records(handle, path, size) if code in (mcap.HEADER, mcap.METADATA, mcap.CHUNK))
    assert found.agg(F.sum("header_bytes")).first()[0] == 9 * records
    assert spark.read.parquet(f"{index}/splits").agg(F.sum("chunks"), F.max("split")).first() == (found.count(), found.agg(F.max("split")).first()[0])


def test_everything_is_read_through_the_index(spark, recordings, index):
    whole = mcap.messages(mcap.scan(spark, recordings))
    assert rows(chunk_index.scan(spark, recordings, index)) == rows(whole)
    places = spark.read.parquet(f"{index}/chunks")
    assert places.agg(F.sum("messages")).first()[0] == whole.count()


def test_filters_reach_the_source(spark, recordings, index):
    whole = mcap.messages(mcap.scan(spark, recordings))
    late = ORIGIN + 2 * SECOND
    conditions = [
        F.col("topic") == contract.LEADER_JOINTS,
        F.col("topic").isin(contract.LEADER_JOINTS, contract.FOLLOWER_JOINTS) & (F.col("log_time_ns") > late),
        (F.col("episode") == "episode_000002") & (F.col("log_time_ns") <= late),
        (F.col("log_time_ns") >= late) & (F.col("log_time_ns") < late + SECOND // 4),
        (F.col("topic") == contract.LEADER_JOINTS) & (F.col("topic") == contract.FOLLOWER_JOINTS),
        F.col("topic") == "/no/such/topic",
        F.col("log_time_ns") == whole.select("log_time_ns").orderBy("log_time_ns").first()[0],
    ]
    for condition in conditions:
        assert rows(chunk_index.scan(spark, recordings, index).filter(condition)) == rows(whole.filter(condition))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = chunk_index.scan(spark, recordings, index).filter(conditions[1])._jdf.queryExecution().explainString(mode)
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and "topic" in pushed[0] and "log_time_ns" in pushed[0]


def test_filters_save_chunks(spark, recordings, index):
    every = spark.read.parquet(f"{index}/chunks").count()
    assert chunks_read(recordings, index) == every
    late = ORIGIN + 3 * SECOND
    some = chunks_read(recordings, index, GreaterThan(("log_time_ns",), late))
    assert 0 < some < every / 2
    assert chunks_read(recordings, index, GreaterThan(("log_time_ns",), late), LessThanOrEqual(("log_time_ns",), late - 1)) == 0
    assert 0 < chunks_read(recordings, index, EqualTo(("episode",), "episode_000002")) < every
    assert chunks_read(recordings, index, In(("topic",), ("/none",))) == 0
    reader = mcap.IndexedReader({"path": recordings, "index": index})
    other = EqualTo(("sequence",), 3)
    assert list(reader.pushFilters([other, In(("topic",), ("/none",))])) == [other]
