"""What is refused, replaced or left out."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telemark import contract, jobs
from telemark.functions.scalar import episode_number
from telemark.sources import mcap, mcap_sink
from tests.conftest import episode_messages, write_episode


def _records(spark, folder):
    return mcap.messages(mcap.scan(spark, str(folder)))


def test_overwrite_replaces_every_earlier_file(spark, recordings, tmp_path):
    target = str(tmp_path / "out")
    rows = jobs.payloads(_records(spark, recordings)).withColumn("position", F.col("record_index"))
    mcap_sink.write_recordings(rows, target)
    first = _records(spark, target).count()
    few = rows.filter((F.col("episode") == "episode_000002") & (F.col("topic") == contract.LEADER_JOINTS))
    mcap_sink.write_recordings(few, target, overwrite=True)
    after = _records(spark, target)
    assert after.count() == few.count() < first
    assert {r.episode for r in after.select("episode").distinct().collect()} == {"episode_000002"}


def test_unknown_episodes_are_refused(spark, recordings):
    with pytest.raises(Exception, match="no such episodes"):
        mcap.scan(spark, recordings, episodes=["episode_000002", "episode_000009"]).count()


def test_spike_repair_refuses_readings_that_are_not_finite(spark, tmp_path):
    rows = episode_messages(60)
    at = next(i for i, r in enumerate(rows) if r[0] == contract.FOLLOWER_JOINTS)
    topic, schema, time, _ = rows[at]
    bad = mcap_sink.joint_payload(time, ["base", *contract.FOLLOWER_JOINT_NAMES], [0.0, float("nan"), *[0.0] * 13])
    rows[at] = (topic, schema, time, bad)
    write_episode(tmp_path / "raw" / "episode_000001", rows)
    with pytest.raises(ValueError, match="not finite"):
        jobs.repair_spikes(spark, str(tmp_path / "raw"), None)


def test_episode_numbers_need_the_whole_name(spark):
    names = spark.createDataFrame([("episode_000012",), ("my_episode_12_x",)], "name string")
    assert [r[0] for r in names.select(episode_number(F.col("name"), F.lit(7))).collect()] == [12, 7]
