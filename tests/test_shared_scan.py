from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telemark.config import ACTION_SIGNAL
from telemark.functions.sequence import numbered, track
from telemark.operators import exposure, motion, quality, resample, shared_scan
from telemark.sources.reports import in_event_order


@pytest.fixture(scope="module")
def frames(spark):
    i = F.col("id")
    rows = spark.range(240).select(
        (i % 3).alias("episode"),
        F.floor(i / 3).alias("frame"),
        (F.floor(i / 3) / 20.0).alias("t"),
        F.transform(F.sequence(F.lit(0), F.lit(13)), lambda j: F.sin(i / 7.0 + j) * F.when(i % 31 == 0, 2.0).otherwise(0.2)).alias("v"),
        F.when(i % 40 < 20, 0.9).otherwise(0.1).alias("l50"),
        F.when(i % 40 < 20, 0.95).otherwise(0.2).alias("l95"),
        F.lit(0.0).alias("highlight_clipping_ratio"),
        F.lit("not read").alias("extra"),
    )
    return track(rows, ["episode"], ["frame"])


def operators(spark):
    limits = motion.urdf_limits(spark, None, [f"j{k}" for k in range(14)], ACTION_SIGNAL)
    return shared_scan.chosen({"motion": {"vector": "v", "time": "t", "limits": limits}, "action": {"vector": "v"}, "exposure": {}})


def same(a, b):
    return sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(a.columns)).collect())) and a.count() > 0


@pytest.mark.parametrize("layout", ["windows", "segments"])
def test_shared_scan_equals_single_runs(spark, frames, layout, request):
    if layout == "segments":
        request.getfixturevalue("small_segments")
    line = track(frames.df, ["episode"], ["frame"])
    made = operators(spark)
    found = shared_scan.shared_scan(line, "frame", made)
    cells = motion.joint_cells(line, "v", "frame", lambda a, b: a - b, "t", radians=True)
    events = motion.motion_events(cells, made["motion"].limits, ["episode"], ACTION_SIGNAL, made["motion"].config)
    assert same(found["motion"]["events"], events)
    assert same(found["motion"]["status"], motion.motion_status(events, line.df, ["episode"]))
    assert same(found["action"]["steps"], quality.action_quality(quality.action_steps(line, "v", "frame"), ["episode"], 25.0))
    alone = exposure.confirmed_frames(line.derive(exposure.candidate_flags()), "frame")
    assert same(found["exposure"]["segments"], exposure.exposure_segments(alone, ["episode"], "frame"))
    assert {r.operator for r in shared_scan.verdicts(found, ["episode"]).collect()} == {"motion", "exposure"}


def test_operators_share_one_shuffle(spark, frames):
    made = operators(spark)
    assert all(isinstance(one, shared_scan.QualityOperator) for one in made.values())
    rows = shared_scan.looked_frames(frames, "frame", made)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "extra" not in rows.columns
    assert shared_scan.needed(made) == ["v", "t", "l50", "l95", "highlight_clipping_ratio"]


def test_refusals(spark, frames):
    with pytest.raises(ValueError, match="unknown operators"):
        shared_scan.chosen({"sound": {}})
    with pytest.raises(ValueError, match="no operator"):
        shared_scan.chosen({})
    with pytest.raises(ValueError, match="lack the columns"):
        shared_scan.shared_scan(frames, "frame", shared_scan.chosen({"action": {"vector": "absent"}}))
    with pytest.raises(ValueError, match="registered already"):
        shared_scan.operator("motion")(object)


def test_numbers_over_a_whole_table(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("v"))
    got = numbered(rows, ["k"], "place").collect()
    assert sorted((r.k, r.place) for r in got) == [(k, k) for k in range(1000)]
    assert numbered(rows.where("false"), ["k"], "place").count() == 0
    events = rows.select((F.col("k") % 5).alias("episode"), F.col("k").alias("frame_index"), F.lit("a").alias("kind"))
    assert [r.frame_index for r in in_event_order(events).collect()] == sorted(range(1000), key=lambda k: (k % 5, k))


def test_pairs_take_every_stream(spark):
    rows = [("e", 0, t, at) for t, at in (("b", 5), ("a", 1), ("z", 9))] + [("e", 1, "a", 4), ("e", 2, "a", 1), ("e", 2, "z", None)]
    table = spark.createDataFrame(rows, "episode string, target_index long, topic string, cleaned_time_ns long")
    got = resample.topic_pairs(table, ["episode"], ["z", "b"]).collect()
    assert sorted((r.left_topic, r.right_topic, r.skew_ns) for r in got) == [("b", "a", 4), ("z", "a", 8), ("z", "b", 4)]
