"""Reading and writing recordings, and the jobs that use them."""

from __future__ import annotations

import json
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telemark import contract, jobs
from telemark.sources import dataset, mcap, mcap_sink
from telemark.sources.annotations import read_annotations
from tests.conftest import ORIGIN, episode_messages, write_episode


def test_messages_have_running_indices_across_files_and_splits(spark, recordings):
    whole = mcap.messages(mcap.scan(spark, recordings))
    split = mcap.messages(mcap.scan(spark, recordings, split_bytes=9000))
    columns = ["episode", "record_index", "topic", "topic_index", "header_time_ns", "cdr_file_offset"]
    one, two = (sorted(map(tuple, m.select(*columns).collect()), key=str) for m in (whole, split))
    assert one == two
    expected = episode_messages()
    first = [r for r in one if r[0] == "episode_000001"]
    assert sorted(r[1] for r in first) == list(range(len(expected)))
    assert [r[2] for r in sorted(first, key=lambda r: r[1])] == [row[0] for row in expected]


def test_topic_filter_keeps_record_numbers(spark, recordings):
    everything = mcap.messages(mcap.scan(spark, recordings))
    some = mcap.messages(mcap.scan(spark, recordings, topics=[contract.LEADER_JOINTS]))
    wanted = everything.filter(F.col("topic") == contract.LEADER_JOINTS)
    columns = ["episode", "record_index", "topic_index"]
    assert set(map(tuple, some.select(*columns).collect())) == set(map(tuple, wanted.select(*columns).collect()))


def test_payload_fields(spark, recordings):
    rows = mcap.messages(mcap.scan(spark, recordings, episodes=["episode_000002"]))
    joint = rows.filter((F.col("topic") == contract.FOLLOWER_JOINTS) & (F.col("topic_index") == 0)).first()
    assert joint.header_time_ns == ORIGIN and joint.names[0] == "base" and len(joint["values"]) == 15
    grip = rows.filter(F.col("topic") == contract.LEFT_GRIPPER_STATE).first()
    assert list(grip["values"]) == [50.0] and grip.header_time_ns is None and grip.primary_time_ns == grip.publish_time_ns
    images = rows.filter((F.col("topic") == contract.HEAD_CAMERA) & (F.col("topic_index") < 5))
    loaded = mcap.fetch(images.select("topic_index", "image.*"), "path", "offset", "size").collect()
    assert {r.topic_index: bytes(r.data) for r in loaded} == {i: bytes([i]) * 40 for i in range(5)}


def test_write_then_read(spark, tmp_path):
    rows = spark.range(300).select(
        F.lit("episode_1").alias("episode"),
        F.col("id").alias("position"),
        F.lit("/test").alias("topic"),
        F.lit("test.Sample").alias("schema_name"),
        F.lit("jsonschema").alias("schema_encoding"),
        F.encode(F.lit('{"type":"object"}'), "utf-8").alias("schema_data"),
        F.lit("json").alias("message_encoding"),
        F.create_map(F.lit("k"), F.lit("v")).alias("channel_metadata"),
        F.col("id").alias("sequence"),
        (F.col("id") * 50_000_000 + 1_000_000_000).alias("log_time_ns"),
        (F.col("id") * 50_000_000 + 1_000_000_000).alias("publish_time_ns"),
        F.encode(F.to_json(F.struct(F.col("id").alias("value"))), "utf-8").alias("data"),
    )
    target = str(tmp_path / "out")
    mcap_sink.write_recordings(rows, target, chunk_bytes=128, file_rows=100, metadata={"note": {"by": "test"}})
    back = mcap.messages(mcap.scan(spark, target))
    full = mcap.fetch(back, "source_file", "cdr_file_offset", "cdr_size").orderBy("record_index").collect()
    assert [r.sequence for r in full] == list(range(300))
    assert json.loads(bytes(full[7].data)) == {"value": 7}
    assert full[0].schema_name == "test.Sample" and full[0].channel_metadata == {"k": "v"}
    assert back.select("source_file").distinct().count() == 3
    with pytest.raises(Exception, match="output exists"):
        mcap_sink.write_recordings(rows, target)


def test_metadata_stands_between_chunks(tmp_path):
    path = tmp_path / "m.mcap"
    messages = [mcap_sink.Message("/t", ("s", "jsonschema", b"{}"), "json", (), n, n, n, b"{}") for n in range(2)]
    path.write_bytes(b"".join(mcap_sink.recording(messages, {"note": {"a": "b"}})))
    with path.open("rb") as handle:
        size = path.stat().st_size
        outer = list(mcap.outer_records(handle, str(path), size - 8))
        inside = [
            code
            for kind, at, length in outer
            if kind == mcap.CHUNK
            for code in mcap.Layout(mcap.chunk_body(handle, str(path), at, length)[0]).code.tolist()
        ]
    assert mcap.METADATA in [kind for kind, _, _ in outer] and mcap.METADATA not in inside


def _file(path, chunk: bytes, tail: bytes = b""):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(mcap.MAGIC + mcap_sink._record(mcap.CHUNK, chunk) + tail + mcap.MAGIC)
    return str(path.parent)


def _chunk(records: bytes, compression: str = "", crc: int = 0) -> bytes:
    head = struct.pack("<QQQI", 0, 0, len(records), crc) + mcap_sink._text(compression)
    return head + struct.pack("<Q", len(records)) + records


def _message(channel: int = 1, data: bytes = b"{}") -> bytes:
    return mcap_sink._record(mcap.MESSAGE, struct.pack(mcap.ENVELOPE, channel, 0, 5, 5) + data)


_CHANNEL = mcap_sink._record(
    mcap.CHANNEL, struct.pack("<HH", 1, 0) + mcap_sink._text("/t") + mcap_sink._text("json") + mcap_sink._mapping({})
)


@pytest.mark.parametrize(
    ("chunk", "text"),
    [
        (_chunk(b"", compression="lz4"), "only uncompressed"),
        (_chunk(_message()), "unknown channel"),
        (_chunk(_CHANNEL[:-3]), "exceeds its container"),
        (_chunk(_CHANNEL + b"abc"), "trailing bytes"),
    ],
)
def test_broken_recordings_are_refused(spark, tmp_path, chunk, text):
    folder = _file(tmp_path / "episode_1" / "a.mcap", chunk)
    with pytest.raises(Exception, match=text):
        mcap.scan(spark, folder).collect()


def test_messages_outside_chunks_are_ignored_and_checksums_recorded(spark, tmp_path):
    folder = _file(tmp_path / "episode_1" / "a.mcap", _chunk(_CHANNEL + _message(), crc=7), tail=_message())
    raw = mcap.scan(spark, folder)
    assert mcap.messages(raw).count() == 1
    assert mcap.unpatchable(raw).count() == 1


def test_missing_folder_and_empty_folder(spark, tmp_path):
    for folder in (tmp_path / "none", tmp_path):
        with pytest.raises(Exception, match="(?i)none|no recordings"):
            mcap.scan(spark, str(folder))


def test_clean_resample_convert(spark, recordings, tmp_path):
    cleaned, aligned, unique, trained = (str(tmp_path / name) for name in ("cleaned", "aligned", "unique", "trained"))
    fixes = jobs.clean(spark, recordings, cleaned)
    changed = fixes.filter(F.col("correction_ms") != 0)
    assert changed.select("episode").distinct().count() == 1 and changed.count() > 0
    before = mcap.messages(mcap.scan(spark, recordings))
    after = mcap.messages(mcap.scan(spark, cleaned))
    assert before.count() == after.count()
    key = ["episode", "record_index"]
    same = before.select(*key, "topic", "cdr_size").exceptAll(after.select(*key, "topic", "cdr_size"))
    assert same.isEmpty()
    moved = after.select(*key, F.col("header_time_ns").alias("n")).join(
        fixes.select("episode", F.col("mcap_record_index").alias("record_index"), "corrected_header_time_ns"), key
    )
    assert moved.filter(F.col("n") != F.col("corrected_header_time_ns")).isEmpty()
    # Cleaning clean data changes nothing.
    again = jobs.clean(spark, cleaned, str(tmp_path / "twice"), dry_run=True)
    assert again.filter(F.col("correction_ms") != 0).isEmpty()

    mappings = jobs.resample_recordings(spark, cleaned, aligned, fps=20.0, require_cleaned=True)
    per_target = mappings.groupBy("episode", "target_index").count().select("count").distinct().collect()
    assert [r[0] for r in per_target] == [9]
    out = mcap.messages(mcap.scan(spark, aligned))
    targets = mappings.select("episode", "target_index").distinct().count()
    assert out.filter(F.col("topic").isin(*contract.REQUIRED_TOPICS)).count() == targets * 9
    assert out.filter(F.col("topic").startswith("/resampling/")).count() == targets * 10
    jobs.resample_recordings(spark, cleaned, unique, fps=20.0, mode="unique")
    selected = mappings.select("episode", "topic", "source_index").distinct().count()
    assert mcap.messages(mcap.scan(spark, unique)).count() == selected
    tables = jobs.analyze_resampling(mappings, spark.read.parquet(f"{aligned}/samples"))
    streams = tables["streams"].collect()
    assert len(streams) == 18
    for row in streams:
        assert row.selected_unique_count + row.omitted_source_count == row.source_count
        assert row.past_source_count + row.exact_source_count + row.future_source_count == row.target_count
    assert tables["pairs"].count() == 2 * 36

    jobs.convert(spark, cleaned, trained, task="sort the parts")
    frames = dataset.read_frames(spark, trained)
    assert dataset.broken_episodes(frames).isEmpty()
    assert frames.groupBy("episode_index").count().count() == 2
    first = frames.filter("episode_index = 0 AND frame_index = 0").first()
    assert len(first["observation.state"]) == 16 and first["action"][14] == 0.5
    info = dataset.read_json(f"{trained}/meta/info.json")
    assert info["total_frames"] == frames.count()
    names = dataset.feature_names(info, "action", 16)[:14]
    from telemark.config import ACTION_SIGNAL
    from telemark.operators import motion

    report = jobs.inspect_motion(frames, names, "action", motion.urdf_limits(spark, None, names, ACTION_SIGNAL), ACTION_SIGNAL)
    assert {r.status for r in report["status"].collect()} == {"fail", "pass"}
    shared = jobs.inspect_converted(spark, trained)
    assert sorted(map(tuple, shared["motion"]["status"].collect())) == sorted(map(tuple, report["status"].select(shared["motion"]["status"].columns).collect()))
    assert shared["motion"]["events"].count() == report["events"].count() > 0
    with pytest.raises(ValueError, match="unknown operators"):
        jobs.inspect_converted(spark, trained, chosen=["sound"])
    with pytest.raises(ValueError, match="not in the dataset"):
        dataset.read_episodes(spark, trained, [0, 9])


def test_output_must_not_lie_inside_the_input(spark, recordings):
    with pytest.raises(ValueError, match="input folder"):
        jobs.clean(spark, recordings, recordings + "/out")


def test_conversion_rejects_bad_episodes(spark, tmp_path):
    rows = [r for r in episode_messages(60) if r[0] != contract.LEFT_GRIPPER_STATE]
    write_episode(tmp_path / "raw" / "episode_1", rows)
    with pytest.raises(ValueError, match="missing required topic"):
        jobs.convert(spark, str(tmp_path / "raw"), str(tmp_path / "out"), task="x")


def test_spike_repair_and_audit(spark, recordings, tmp_path):
    result = jobs.repair_spikes(spark, recordings, str(tmp_path / "fixed"), topic=contract.LEADER_JOINTS)
    status = {r.episode: r.status for r in result["status"].collect()}
    assert status == {"episode_000001": "repaired", "episode_000002": "clean"}
    after = mcap.messages(mcap.scan(spark, str(tmp_path / "fixed"), topics=[contract.LEADER_JOINTS]))
    row = after.filter("episode = 'episode_000001' AND topic_index = 20").first()
    assert abs(row["values"][4]) < 12
    audit = jobs.audit_joints(spark, recordings)
    found = {(r.episode, r.topic): r.status for r in audit["status"].collect()}
    assert found["episode_000001", contract.LEADER_JOINTS] == "review"
    assert found["episode_000002", contract.LEADER_JOINTS] == "clean_under_checked_thresholds"
    largest = audit["largest_step"].filter("episode = 'episode_000001'").filter(F.col("topic") == contract.LEADER_JOINTS).first()
    assert largest.joint == 3 and largest.from_frame in (19, 20)


def test_quality_report(spark, recordings, tmp_path):
    path = tmp_path / "annotations.json"
    path.write_text(json.dumps({"episode_000001": {"success": False, "task": "sort"}, "episode_000002": {"success": True}}))
    import numpy as np

    def decode(data: bytes):
        return np.full((4, 4 + data[0] % 2, 3), data[0], np.uint8)

    report = jobs.inspect_quality(spark, recordings, annotations=read_annotations(spark, str(path)), task="default", decode=decode)
    assert report["picture_samples"].groupBy("episode", "topic").count().select("count").distinct().collect() == [(24,)]
    assert report["picture_hashes"].filter("duplicate_hashes > 0").isEmpty()
    risks = {(r.episode, r.risk_id): r.status for r in report["risks"].collect()}
    assert risks["episode_000001", "demonstration_failed"] == "fail"
    assert risks["episode_000002", "success_label_verified"] == "pass"
    assert risks["episode_000001", "camera_timestamp_nonpositive"] == "warning"
    assert risks["episode_000001", "image_shape_changed"] == "fail"
    assert {r.episode: r.overall_status for r in report["episodes"].collect()}["episode_000001"] == "fail"
    path.write_text(json.dumps({"episode_000001": {"colour": 1}}))
    with pytest.raises(ValueError, match="unknown settings"):
        read_annotations(spark, str(path))


def test_camera_frames_and_exposure(spark, recordings):
    import numpy as np

    def decode(data: bytes):
        if data[0] == 7:
            raise ValueError("broken picture")
        return np.full((2, 3, 3), 255 if data[0] < 5 else 0, np.uint8)

    report = jobs.inspect_cameras(spark, recordings, decode, episodes=["episode_000001"], max_frames=20)
    frames = report["frames"]
    assert frames.count() == 3 * 19 and report["failures"].count() == 3
    segments = {r.camera: (r.start_frame, r.end_frame) for r in report["segments"].collect()}
    assert segments == {topic: (0, 4) for topic in contract.IMAGE_TOPICS}
    assert [r.status for r in report["status"].collect()] == ["warning"]
    head = frames.filter(F.col("camera") == contract.HEAD_CAMERA).orderBy("frame_index").collect()
    assert head[0].timestamp_s == 0.0 and abs(head[3].timestamp_s - 0.1) < 1e-3


def test_jump_evidence(spark, recordings):
    found = jobs.jump_evidence(spark, recordings)
    jump = found["strongest"].collect()
    assert [r.episode for r in jump] == ["episode_000001"] and jump[0].joints == [3]
    windows = {(r.episode, r.window): (r.start_frame, r.end_frame) for r in found["windows"].collect()}
    low, high = windows["episode_000001", "jump"]
    assert low <= jump[0].sample_start and high >= jump[0].sample_end
    low, high = windows["episode_000001", "normal"]
    assert not low <= 20 <= high and ("episode_000002", "normal") in windows
    pictures = found["pictures"].filter("episode = 'episode_000001' AND window = 'jump'").collect()
    assert len(pictures) == 1 and abs(pictures[0].delta_ns) <= 40_000_000


def test_snapshots_notice_changes(spark, tmp_path):
    from telemark.sources.episodes import changed_files, file_snapshot

    write_episode(tmp_path / "episode_1", episode_messages(4))
    before = file_snapshot(spark, str(tmp_path))
    assert changed_files(before, file_snapshot(spark, str(tmp_path))).isEmpty()
    with (tmp_path / "episode_1" / "part_0.mcap").open("ab") as handle:
        handle.write(b"x")
    assert changed_files(before, file_snapshot(spark, str(tmp_path))).count() == 1


def test_small_files_share_tasks(spark, tmp_path):
    files = 300
    rows = [("/t", "s", ORIGIN + n, b"{}") for n in range(10 * files)]
    write_episode(tmp_path / "raw" / "episode_1", rows, files=files)
    raw = mcap.scan(spark, str(tmp_path / "raw"), split_bytes=64)  # several ranges a file
    spark.dataSource.register(mcap.McapSource)
    reader = mcap.McapReader({"path": str(tmp_path / "raw"), "splitBytes": "64", "tasks": "8"})
    shares = reader.partitions()
    assert 8 <= len(shares) <= 16
    assert sum(len(list(share.pieces)) for share in shares) > files
    assert sum(b.num_rows for share in shares for b in reader.read(share)) == 12 * files  # a marker a chunk, an end a file
    assert [r.record_index for r in mcap.messages(raw).orderBy("record_index").collect()] == list(range(10 * files))


def test_batches_do_not_show_in_files(tmp_path):
    maps = [None, [], [("a", "1")], [("a", "1"), ("b", "2")], [("b", "2"), ("a", "1")], [("a", "2")]]
    messages = []
    for n in range(500):
        schema = (None, None, b"") if n % 7 == 0 else (f"s{n % 3}", "jsonschema", b"{}")
        messages.append(mcap_sink.Message(f"/{n % 4}", schema, "json", tuple(sorted(maps[n % 6] or ())), n, n * 5, n * 3, b"x" * (n % 50)))
    columns = {
        "episode": ["e"] * 500, "part": [0] * 500, "position": list(range(500)), "topic": [m.topic for m in messages],
        "schema_name": [m.schema[0] for m in messages], "schema_encoding": [m.schema[1] for m in messages],
        "schema_data": [m.schema[2] or None for m in messages], "message_encoding": ["json"] * 500, "channel_metadata": [maps[n % 6] for n in range(500)],
        "sequence": list(range(500)), "log_time_ns": [m.log_time for m in messages], "publish_time_ns": [m.publish_time for m in messages],
        "data": [m.data for m in messages],
    }
    kinds = {"schema_data": pa.binary(), "data": pa.binary(), "channel_metadata": pa.map_(pa.string(), pa.string())}
    whole = pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k)) for k, v in columns.items()})
    want = b"".join(mcap_sink.recording(messages, None, 700))
    for rows in (1, 33, 500):
        batches = [whole.slice(at, rows) for at in range(0, 500, rows)]
        runs = [run for batch in batches for *_, run in mcap_sink._runs(batch)]
        assert b"".join(mcap_sink._file(runs, None, 700)) == want
    # the format itself, message by message
    body = b"".join(bytes(b) for b in _bodies(tmp_path, want))
    numbers = [struct.unpack_from(mcap.ENVELOPE, data)[1:] + (bytes(data[mcap.ENVELOPE_BYTES :]),) for data in _contents(body)]
    assert numbers == [tuple(m[4:]) for m in messages]


def _bodies(folder, raw: bytes):
    path = folder / "whole.mcap"
    path.write_bytes(raw)
    with path.open("rb") as handle:
        for kind, at, length in mcap.outer_records(handle, str(path), len(raw)):
            if kind == mcap.CHUNK:
                yield mcap.chunk_body(handle, str(path), at, length)[0]


def _contents(body: bytes):
    layout = mcap.Layout(memoryview(body))
    for code, start, size in zip(layout.code.tolist(), layout.start.tolist(), layout.size.tolist()):
        if code == mcap.MESSAGE:
            yield body[start : start + size]


@pytest.mark.parametrize("ahead", [1, 1 << 16])
def test_fetch_in_small_pieces(spark, tmp_path, monkeypatch, ahead):
    monkeypatch.setattr(mcap, "AHEAD_BYTES", ahead)
    monkeypatch.setattr(mcap, "FETCH_BYTES", 30)
    content = bytes(range(256)) * 2
    for name in "ab":
        (tmp_path / name).write_bytes(content)
    places = [(str(tmp_path / "ab"[n % 2]), (n * 37) % 400, n % 60) for n in range(100)] + [(None, 0, 0)]
    rows = spark.createDataFrame(places, "path string, at long, size long").coalesce(1)
    got = mcap.fetch(rows, "path", "at", "size").collect()
    assert len(got) == 101
    assert all(r.data is None if r.path is None else bytes(r.data) == content[r.at : r.at + r.size] for r in got)
