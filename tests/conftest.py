from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))

from telemark import contract  # noqa: E402
from telemark.sources import mcap_sink  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_segments(spark):
    """Make groups count as very large, so that the segmented layout is used."""
    spark.conf.set("telemark.segmentRows", "40")
    yield
    spark.conf.unset("telemark.segmentRows")


SECOND = 1_000_000_000
ORIGIN = 1_700_000_000 * SECOND


def episode_messages(frames: int = 120, *, spike: bool = True, freeze: bool = True):
    """(topic, schema, log time, payload) of one synthetic episode of ``frames``/30 seconds."""
    rows = []
    length = frames * SECOND // 30
    for topic in contract.IMAGE_TOPICS:
        for i in range(frames):
            at = ORIGIN + i * SECOND // 30
            stamp = at
            if freeze and topic == contract.HEAD_CAMERA and i % 50 in (30, 31, 32):
                stamp = ORIGIN + (i - i % 50 + 29) * SECOND // 30
            data = bytes([i % 256]) * 40
            rows.append((topic, contract.IMAGE_SCHEMA, at + 2_000_000, mcap_sink.image_payload(stamp, data)))
    for topic, names, step, shift in (
        (contract.FOLLOWER_JOINTS, contract.FOLLOWER_JOINT_NAMES, SECOND // 50, 0.0),
        (contract.LEADER_JOINTS, contract.LEADER_JOINT_NAMES, SECOND // 26, 0.5),
    ):
        for i, at in enumerate(range(0, length, step)):
            values = [10.0 * np.sin(at / SECOND + j) + shift for j in range(14)]
            if spike and topic == contract.LEADER_JOINTS and i == 20:
                values[3] += 60.0
            payload = mcap_sink.joint_payload(ORIGIN + at, ["base", *names], [0.0, *values])
            rows.append((topic, contract.JOINT_SCHEMA, ORIGIN + at + 1_000_000, payload))
    for topic in (t for t in contract.REQUIRED_TOPICS if "gripper" in t):
        for at in range(0, length, SECOND // 40):
            rows.append((topic, contract.GRIPPER_SCHEMA, ORIGIN + at, mcap_sink.gripper_payload(50.0)))
    return sorted(rows, key=lambda row: row[2])


def write_episode(folder: Path, rows, *, files: int = 2, chunk_bytes: int = 4096) -> None:
    folder.mkdir(parents=True)
    per_file = -(-len(rows) // files)
    for number in range(files):
        messages = [
            mcap_sink.Message(topic, (schema, "ros2msg", b""), "cdr", (), sequence, at, at, payload)
            for sequence, (topic, schema, at, payload) in enumerate(rows[number * per_file : (number + 1) * per_file])
        ]
        (folder / f"part_{number}.mcap").write_bytes(b"".join(mcap_sink.recording(messages, chunk_bytes=chunk_bytes)))


@pytest.fixture(scope="session")
def recordings(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    write_episode(root / "episode_000001", episode_messages())
    write_episode(root / "episode_000002", episode_messages(90, spike=False, freeze=False))
    return str(root)
