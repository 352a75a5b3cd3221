"""Hand-computed cases of the operators, in both layouts of a track."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemark.config import (
    Exposure,
    HeadTimestamp,
    JointSignal,
    PipelineConfig,
    SpikeRepair,
    TimestampQuality,
    load_operator_config,
    load_pipeline_config,
)
from telemark.functions import scalar
from telemark.functions.quantile import summarise
from telemark.functions.sequence import carry, islands, run_extent, track
from telemark.operators import align, detection, exposure, images, motion, quality, repair, replay, spikes, timeline

MS = 1_000_000


def series(spark, times, topic="a"):
    rows = [(topic, i, int(t)) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "topic string, i bigint, t bigint")


def line(spark, times, topic="a"):
    return track(series(spark, times, topic), ["topic"], ["i"])


# --- sequence kit: both layouts give the same rows ---

def _mixed(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        key = "hot" if rnd.random() < 0.6 else rnd.choice("bcd")
        # One time holds a third of the rows, and one stray time stretches the range.
        t = 5 if rnd.random() < 0.33 else rnd.randint(0, 10**6)
        rows.append((key, i, t, rnd.random() if rnd.random() < 0.8 else None, rnd.random() < 0.5))
    rows.append(("hot", 600, 10**15, 1.0, True))
    return spark.createDataFrame(rows, "k string, i bigint, t bigint, v double, f boolean").cache()


@pytest.mark.parametrize("order", [["i"], ["t", "i"]])
def test_segments_change_nothing(spark, order):
    df = _mixed(spark)
    columns = ["k", "i", "p", "p2", "n", "l", "fi", "ru", "num", "island", "run_first", "run_last"]

    def run():
        base = track(df, ["k"], order)
        looked = carry(
            base,
            prev={"p": F.col("v")},
            prev2={"p2": F.col("i")},
            next={"n": F.col("v")},
            last={"l": F.col("v")},
            first={"fi": F.col("v")},
            running={"ru": F.col("i")},
            number="num",
        )
        if order == ["i"]:
            looked = run_extent(islands(looked, F.col("f"), "i"), F.col("f"), "i")
        kept = [c for c in columns if c in looked.df.columns]
        return base.segments, sorted(map(str, looked.rows().select(*kept).collect()))

    plain_segments, plain = run()
    spark.conf.set("telemark.segmentRows", "60")
    try:
        segments, cut = run()
        sizes = track(df, ["k"], order)
        largest = sizes.df.groupBy("k", *sizes.segments).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("telemark.segmentRows")
    assert plain_segments == () and segments != () and plain == cut and largest <= 240


def test_exact_percentiles_in_both_layouts(spark):
    df = _mixed(spark)
    wanted = {"v": (F.col("v"), {"m": 0.5, "p95": 0.95, "top": 1.0}), "t": (F.col("t"), {"tm": 0.5, "t99": 0.99})}

    def run():
        return sorted(map(tuple, summarise(df, ["k"], [F.count("*").alias("c")], wanted).select("k", "c", "m", "p95", "top", "tm", "t99").collect()))

    plain = run()
    spark.conf.set("telemark.segmentRows", "30")
    try:
        assert run() == plain
    finally:
        spark.conf.unset("telemark.segmentRows")
    for key, _, median, p95, *_ in plain:
        values = [r.v for r in df.filter(F.col("k") == key).collect() if r.v is not None]
        assert math.isclose(median, np.percentile(values, 50)) and math.isclose(p95, np.percentile(values, 95))


# --- clocks ---

def test_gap_statistics_of_a_faulty_clock(spark):
    stream = line(spark, np.array([0, 33, 33, 20, 53, 153]) * MS)
    row = timeline.gap_statistics(stream, "t").first()
    assert (row.duplicate_count, row.negative_count, row.nonpositive_count, row.warning_gap_count) == (1, 1, 2, 1)
    events = timeline.gap_events(stream, "t", "i").collect()
    assert len(events) == 1 and events[0].period_multiple > 3 and events[0].edge_after_source_index == 4


def test_gap_statistics_without_any_regular_step(spark):
    row = timeline.gap_statistics(line(spark, [5, 5, 5]), "t").first()
    assert row.nominal_period_ms is None and row.warning_gap_count == 0 and row.effective_hz == 0.0


def test_step_anomalies_round_half_to_even(spark):
    judged = timeline.judged_steps(line(spark, np.cumsum([0, 10, 25, 35, 0, -5])), "t", F.lit(10))
    assert {r.step_ns: r.rounded_multiple for r in judged.collect()} == {10: 1, 25: 2, 35: 4, 0: 0, -5: 0}


# --- alignment ---

def nearest(source, target):
    right = np.clip(np.searchsorted(source, target), 1, len(source) - 1)
    left = right - 1
    return np.where(np.abs(target - source[left]) <= np.abs(source[right] - target), left, right)


def test_nearest_takes_the_earlier_source_on_a_tie(spark):
    sources = series(spark, np.array([0, 40, 80, 120]) * MS).withColumnRenamed("t", "s")
    targets = series(spark, np.array([20, 55, 115, -7, 500]) * MS).withColumnRenamed("i", "n").withColumnRenamed("t", "q")
    found = align.nearest_asof(targets, sources, ["topic"], "q", "s", ["i"], source_order="i").orderBy("n").collect()
    assert [r.i for r in found] == [0, 1, 3, 0, 3]
    assert [r.residual_ns // MS for r in found][:3] == [-20, -15, 5]


def test_nearest_with_repeated_source_times(spark):
    sources = series(spark, [0, 10, 10, 10, 20]).withColumnRenamed("t", "s")
    targets = series(spark, [9, 10, 11, 15]).withColumnRenamed("i", "n").withColumnRenamed("t", "q")
    found = align.nearest_asof(targets, sources, ["topic"], "q", "s", ["i"], source_order="i").orderBy("n").collect()
    assert [r.i for r in found] == [1, 1, 3, 3]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 40), min_size=2, max_size=30), st.integers(1, 30), st.booleans())
def test_grid_alignment_matches_binary_search(spark, gaps, period, cut):
    source = np.cumsum([100, *gaps])
    rows = series(spark, source).withColumn("e", F.lit("x"))
    if cut:
        spark.conf.set("telemark.segmentRows", "4")
    try:
        stream = track(rows, ["e", "topic"], ["i"])
        spans = align.common_spans(rows, ["e"], "topic", "t")
        spans = align.integer_grid(spans, 1e9 / period)
        got = align.align_to_grid(stream, spans, ["e"], "t", {"i": F.col("i")}).orderBy("target_index").collect()
    finally:
        spark.conf.unset("telemark.segmentRows")
    targets = np.arange(source[0], source[-1] + 1, period)
    want = nearest(source, targets)
    assert [r.target_time_ns for r in got] == targets.tolist()
    assert [r.i for r in got] == want.tolist()
    assert [r.reused_previous_source for r in got] == [False, *(want[1:] == want[:-1]).tolist()]


def test_grids_differ_when_the_period_is_no_whole_number(spark):
    spans = spark.createDataFrame([("e", 0, 0, 10**10)], "e string, origin_ns bigint, start_ns bigint, end_ns bigint")
    whole = align.grid_targets(align.integer_grid(spans, 30), ["e"])
    real = align.grid_targets(align.rounded_grid(spans, 30), ["e"], fractional=True)
    at = lambda df: {r.target_index: r.target_time_ns for r in df.collect()}
    assert at(whole)[300] == 300 * 33_333_333 and at(real)[300] == 10**10
    same = align.grid_targets(align.rounded_grid(spans, 20), ["e"], fractional=True)
    assert at(same) == at(align.grid_targets(align.integer_grid(spans, 20), ["e"]))


# --- timestamp repair ---

def _clock(frames=120, period=33_333_333):
    rnd = random.Random(7)
    return np.array([10**9 + i * period + rnd.randint(-200_000, 200_000) for i in range(frames)])


def repaired(spark, times, config=None):
    done = repair.repair_timestamps(line(spark, times), "i", "t", config or HeadTimestamp()).rows()
    return done.orderBy("i").collect()


def test_clean_clock_stays(spark):
    rows = repaired(spark, _clock())
    assert all(r.correction_ns == 0 and r.repair_method == "original" for r in rows)


@pytest.mark.parametrize("cut", [False, True])
def test_repair_of_freeze_jump_and_offset(spark, cut):
    times = _clock(200)
    clean = times.copy()
    times[40:43] = times[39]  # freeze
    times[90] -= 100_000_000  # back jump
    times[120:160] += 70_000_000  # long offset
    times[0] -= 80_000_000  # bad first frame
    if cut:
        spark.conf.set("telemark.segmentRows", "30")
    try:
        rows = repaired(spark, times)
    finally:
        spark.conf.unset("telemark.segmentRows")
    methods = [r.repair_method for r in rows]
    assert methods[40:43] == ["local_interpolation"] * 3 and methods[90] == "local_interpolation"
    assert set(methods[121:160]) == {"robust_regression"} and methods[0] == "robust_regression"
    stamps = [r.corrected_ns for r in rows]
    assert all(b > a for a, b in zip(stamps, stamps[1:], strict=False))
    assert max(abs(a - b) for a, b in zip(stamps, clean, strict=True)) < 2_000_000
    assert rows[90].risk == "high" and rows[40].risk in ("none", "warning")


def _guarded(corrected, predicted, step):
    out = [corrected[0]]
    for value, guess in zip(corrected[1:], predicted[1:], strict=True):
        out.append(value if value > out[-1] else max(guess, out[-1] + step))
    return out


@pytest.mark.parametrize("cut", [False, True])
def test_monotonic_guard_follows_the_sequential_rule(spark, cut):
    rnd = random.Random(2)
    raw = [i * 10 + rnd.randint(-40, 40) for i in range(150)]
    guess = [i * 10 for i in range(150)]
    rows = spark.createDataFrame([("a", i, r, g) for i, (r, g) in enumerate(zip(raw, guess, strict=True))], "topic string, i bigint, corrected_ns bigint, predicted_ns bigint")
    rows = rows.withColumns({"period_ns": F.lit(10).cast("bigint"), "repair_method": F.lit("original")})
    if cut:
        spark.conf.set("telemark.segmentRows", "20")
    try:
        done = repair.monotonic_guard(track(rows, ["topic"], ["i"]), HeadTimestamp()).rows().orderBy("i").collect()
    finally:
        spark.conf.unset("telemark.segmentRows")
    assert [r.corrected_ns for r in done] == _guarded(raw, guess, 8)


def test_guard_of_a_segment_for_any_entry():
    """The step function of a segment, and its frames for each entry, against the rule frame by frame."""
    rnd = np.random.default_rng(5)
    for _ in range(400):
        n, step = int(rnd.integers(1, 40)), int(rnd.integers(1, 8))
        raw, guess = np.cumsum(rnd.integers(-6, 12, n)), np.arange(n) * 3 + rnd.integers(-20, 20, n)
        part = repair.Advance(raw, guess, step)
        for entry in (None, *rnd.integers(-60, 150, 3).tolist()):
            before, want = entry, []
            for value, other in zip(raw.tolist(), guess.tolist(), strict=True):
                before = value if before is None or value > before else max(other, before + step)
                want.append(before)
            values, pushed = part.apply(entry)
            assert values.tolist() == want and pushed.tolist() == [a != b or p for a, b, p in zip(want, raw.tolist(), pushed.tolist(), strict=True)]
            assert repair.passed_on(entry, **part.summary()) == want[-1]


def test_too_few_frames_are_reported(spark):
    short = line(spark, [0, 33 * MS])
    done = repair.repair_timestamps(short, "i", "t")
    assert repair.unrepairable(short, done.df).count() == 1


def test_period_outside_the_search_band_uses_the_usual_step(spark):
    period = repair.nominal_period(line(spark, np.arange(40) * 10 * MS), "t", HeadTimestamp()).first()
    assert period.period_ns == 10 * MS
    fixed = repair.nominal_period(line(spark, np.arange(5) * MS), "t", HeadTimestamp(nominal_period_ms=33.0)).first()
    assert fixed.period_ns == 33 * MS


def test_affine_repair_only_touches_faulty_clocks(spark):
    good, bad = [0, 7, 20], [0, 5, 5, 30]
    for times, want in ((good, good), (bad, [0, 10, 20, 30])):
        rows = repair.affine_repair(line(spark, times), "i", "t").orderBy("i").collect()
        assert [r.repaired_ns for r in rows] == want


# --- joints ---

def frames_of(spark, vectors, dt=0.05):
    rows = [("e", i, i * dt, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return track(spark.createDataFrame(rows, "episode string, frame bigint, s double, v array<double>"), ["episode"], ["frame"])


def judged_runs(spark, values, **limits):
    config = SpikeRepair(**{"max_step_deg": 25.0, "max_velocity_deg_s": 1e9, **limits})
    frames = frames_of(spark, [[x] for x in values])
    extent = frames.df.groupBy("episode").agg(F.count("*").alias("frames"), F.min("s").alias("origin_s"))
    edges = spikes.joint_edges(frames, "v", "frame", F.col("s"), config)
    runs = spikes.spike_runs(edges, extent, ["episode"], config)
    return runs, spikes.repaired_cells(runs, ["episode"], config)


@pytest.mark.parametrize(
    ("values", "reason"),
    [
        ([0] * 5 + [60] + [0] * 5, None),
        ([0] * 5 + [60, 0, 60] + [0] * 5, None),
        ([0] * 5 + [60] * 6, "persistent_step"),
        ([0] + [60] + [0] * 8, "boundary_event"),
        ([0] * 4 + [60, 0] * 4 + [0] * 4, "run_too_long"),
        ([0] * 5 + [30, 56, 30] + [14] * 4, "persistent_step"),
    ],
)
def test_spike_rules(spark, values, reason):
    runs, cells = judged_runs(spark, values)
    assert {r.reason for r in runs.collect()} == {reason}
    assert (cells.count() > 0) == (reason is None)
    assert all(abs(r.corrected) < 1e-9 for r in cells.collect())


def test_small_residual_is_left_for_review(spark):
    runs, _ = judged_runs(spark, [0] * 5 + [4] + [0] * 5, max_step_deg=3.0)
    assert [r.reason for r in runs.collect()] == ["small_interpolation_residual"]


@pytest.mark.parametrize(("out", "back", "hit"), [(5.0, 0.0, True), (4.999, 0.0, False), (6.0, 1.0, True), (6.0, 1.001, False)])
def test_spike_limits_are_inclusive(spark, out, back, hit):
    frames = frames_of(spark, [[0.0], [out], [back]])
    cells = motion.joint_cells(frames, "v", "frame", lambda a, b: a - b, "s", radians=False)
    flags = motion.audit_flags(cells, JointSignal(25, 500), load_operator_config().joint_motion)
    assert flags.filter("spike").count() == int(hit)


def test_limits_match_by_canonical_name(spark):
    urdf = '<robot><joint name="arm_L_joint1"><limit lower="-1" upper="1" velocity="2"/></joint></robot>'
    row = motion.urdf_limits(spark, urdf, ["arm_l_j1"], JointSignal(25, 500)).first()
    assert (row.lower_rad, row.upper_rad, row.max_velocity_rad_s) == (-1.0, 1.0, 2.0)
    with pytest.raises(Exception, match="no limits for joint"):
        motion.urdf_limits(spark, urdf, ["arm_l_j2"], JointSignal(25, 500)).collect()


def test_normal_window_prefers_motion(spark):
    still = [[0.0]] * 60
    moving = [[float(i)] for i in range(20)]
    frames = frames_of(spark, still + moving, dt=0.1)
    config = SpikeRepair(max_step_deg=25.0, max_velocity_deg_s=500.0)
    runs = spikes.clean_runs(frames, "v", "frame", F.col("s"), 1, config)
    window = spikes.normal_window(frames, runs, "v", "frame", F.col("s"), 1, 0.5).collect()
    assert len(window) == 1 and window[0].start_frame >= 60 and window[0].motion_deg >= 4


def test_normal_window_has_runs_to_choose_from(spark):
    from telemark.plans import joints

    assert joints.normal_window(spark, "/root/testdata/sf0.001").count() == 10  # an episode each


# --- exposure, images ---

@pytest.mark.parametrize(("pattern", "segments"), [("..11..", 0), (".111..", 1), ("11.1", 0), ("111111", 1), ("111.111", 2)])
def test_exposure_needs_three_frames_in_a_row(spark, pattern, segments):
    rows = [("c", i, 0.5, 0.95, 0.0) if c == "1" else ("c", i, 0.0, 0.0, 0.0) for i, c in enumerate(pattern)]
    df = spark.createDataFrame(rows, "camera string, f bigint, l50 double, l95 double, highlight_clipping_ratio double")
    shots = track(df, ["camera"], ["f"]).derive(exposure.candidate_flags())
    confirmed = exposure.confirmed_frames(shots, "f")
    assert exposure.exposure_segments(confirmed, ["camera"], "f").count() == segments


def test_a_missing_frame_splits_a_run(spark):
    rows = [("c", i, 0.5, 0.95, 0.0) for i in (0, 1, 3, 4)]
    df = spark.createDataFrame(rows, "camera string, f bigint, l50 double, l95 double, highlight_clipping_ratio double")
    shots = track(df, ["camera"], ["f"]).derive(exposure.candidate_flags())
    assert exposure.confirmed_frames(shots, "f").filter("confirmed").isEmpty()


def test_image_metrics_of_known_pictures(spark):
    def picture(name, pixels):
        return (name, (pixels.shape[0], pixels.shape[1], 3, pixels.tobytes()))

    white, black = np.full((8, 8, 3), 255, np.uint8), np.zeros((8, 8, 3), np.uint8)
    half = np.concatenate([white, black])
    rows = [picture("white", white), picture("black", black), picture("half", half)]
    df = spark.createDataFrame(rows, "name string, image struct<height:int,width:int,nChannels:int,data:binary>")
    light = {r.name: r for r in exposure.image_luminance_metrics(df).collect()}
    assert math.isclose(light["white"].l50, 1.0, rel_tol=1e-6) and light["white"].highlight_clipping_ratio == 1.0
    assert light["black"].l95 == 0.0 and light["half"].highlight_clipping_ratio == 0.5
    gray = {r.name: r for r in images.sample_metrics(df).collect()}
    assert gray["white"].bright_pixel_ratio == 1.0 and gray["black"].dark_pixel_ratio == 1.0
    assert gray["white"].laplacian_variance == 0.0 and gray["half"].laplacian_variance > 0


def test_pictures_from_files(spark, tmp_path):
    """The JVM decodes the pictures; pixels come as blue, green, red."""
    jvm = spark._jvm
    shot = jvm.java.awt.image.BufferedImage(4, 4, 5)
    for x in range(4):
        for y in range(4):
            shot.setRGB(x, y, 0xFF0000)
    jvm.javax.imageio.ImageIO.write(shot, "png", jvm.java.io.File(str(tmp_path / "a.png")))
    df = spark.read.format("image").load(str(tmp_path))
    row = exposure.image_luminance_metrics(df, "image", Exposure()).first()
    assert math.isclose(row.l50, 0.2126, rel_tol=1e-6)


def test_uniform_sample_floors_positions(spark):
    df = spark.range(10).select(F.lit("a").alias("k"), F.col("id").alias("i"))
    assert sorted(r.i for r in images.uniform_sample(df, ["k"], "i", 4).collect()) == [0, 3, 6, 9]
    assert [r.i for r in images.uniform_sample(df, ["k"], "i", 1).collect()] == [0]


# --- the rest ---

def test_scalars(spark):
    row = spark.range(1).select(
        scalar.slug(F.lit("/a b//C-1/")).alias("slug"),
        scalar.slug(F.lit("//")).alias("empty"),
        scalar.canonical_joint(F.lit("arm_R_j7")).alias("short"),
        scalar.canonical_joint(F.lit("arm_l_joint2")).alias("long"),
        scalar.canonical_joint(F.lit("Wheel")).alias("other"),
        scalar.episode_number(F.lit("episode_000012"), F.lit(3)).alias("n"),
        scalar.episode_number(F.lit("x"), F.lit(3)).alias("fallback"),
        scalar.nearest_integer(F.lit(2.5)).alias("even"),
        scalar.join_time(*scalar.split_time(F.lit(-1))).alias("back"),
        scalar.split_time(F.lit(-1))[1].alias("nanos"),
    ).first()
    assert tuple(row) == ("a_b_c_1", "stream", "arm_r_joint7", "arm_l_joint2", "wheel", 12, 3, 2, -1, 999_999_999)


def test_array_metrics_count_nan_and_infinity(spark):
    df = spark.createDataFrame([("a", [1.0, float("nan"), 5.0]), ("a", [3.0, 2.0, 5.0])], "k string, v array<double>")
    rows = {r.dimension: r for r in quality.array_metrics(df, ["k"], "v").collect()}
    assert rows[0].mean_value == 2.0 and rows[1].nan_count == 1 and rows[1].min_value == 2.0
    assert rows[2].constant and not rows[0].constant
    infinite = spark.createDataFrame([("a", [float("inf")]), ("a", [1.0])], "k string, v array<double>")
    row = quality.array_metrics(infinite, ["k"], "v").first()
    assert row.inf_count == 1 and row.finite_ratio == 0.5 and not row.constant


def test_detector_runs_per_batch(spark):
    df = spark.range(4).select(F.col("id").alias("frame_index"))
    load = lambda: lambda batch: [[{"label": "cup", "confidence": 0.9, "bbox_xyxy": [0.0, 0.0, 1.0, 1.0]}] * int(i) for i in batch["frame_index"]]
    found = detection.unfold(detection.detect(df, load, ["frame_index"]), ["frame_index"])
    assert detection.label_counts(found, ["frame_index"]).first()["detections"] == 6
    assert detection.summary(df, found, ["frame_index"]).first().frames_with_detections == 3


def test_replay_selection_by_name(spark):
    names = [f"arm_{s}_joint{i}" for s in "RL" for i in range(1, 8)]
    assert replay.arm_columns(names)[:2] == [7, 8]
    with pytest.raises(ValueError, match="missing"):
        replay.arm_columns(names[:-1])
    chosen = replay.select_frames(spark.range(20).withColumnRenamed("id", "f"), "f", start=3, end=15, stride=4, max_frames=2)
    assert [r.f for r in chosen.collect()] == [3, 7]


def test_configuration(tmp_path):
    path = tmp_path / "c.toml"
    path.write_text("[quality.timestamp]\ngap_warning_factor = 3.0\n[cleaning.head_timestamp]\nshort_run_max_frames = 2\n")
    config = load_pipeline_config(path)
    assert config.timestamp.gap_warning_factor == 3.0 and config.head_timestamp.short_run_max_frames == 2
    path.write_text("[joint_motion.state]\nmax_step_deg = 9.0\n[joint_motion]\nspike_min_step_deg = 4.0\n")
    motion_config = load_operator_config(path).joint_motion
    assert motion_config.state.max_step_deg == 9.0 and motion_config.spike_min_step_deg == 4.0
    with pytest.raises(ValueError, match="fail_factor"):
        PipelineConfig(timestamp=TimestampQuality(gap_warning_factor=6.0))
    with pytest.raises(ValueError, match="at least 1"):
        SpikeRepair(max_repair_run_frames=0)
    with pytest.raises(ValueError, match=r"\[0, 1\]"):
        Exposure(clip_luminance=1.2)


# --- sizes of steps ---

@pytest.fixture
def plain_joins(spark):
    """No broadcasts and no adaptive plans: rows stay where the plan as written puts them."""
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(name, value)
    yield
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
        spark.conf.unset(name)


def test_alignment_spreads_one_episode(spark, small_segments, plain_joins):
    rows = spark.createDataFrame([("e", t, i, 10 * i) for t in "ab" for i in range(400)], "episode string, topic string, i bigint, t bigint")
    spans = align.integer_grid(align.common_spans(rows, ["episode"], "topic", "t"), 1e8)
    mapped = align.align_to_grid(track(rows, ["episode", "topic"], ["i"]), spans, ["episode"], "t", {"source_index": F.col("i")})
    per_task = [r["count"] for r in mapped.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 800 and max(per_task) < 600
    assert mapped.filter("residual_ns <> 0 or source_index <> target_index").isEmpty()


def test_ranks_are_looked_for_in_narrow_bands(spark, small_segments, monkeypatch):
    from telemark.functions import quantile

    r = random.Random(5)
    values = [r.gauss(0, 1) for _ in range(20_000)] + [0.25] * 3_000
    written = []
    durable = quantile.durable
    monkeypatch.setattr(quantile, "durable", lambda df: written.append(durable(df)) or written[-1])
    df = spark.createDataFrame([("a", v) for v in values], "k string, _v double")
    spark.conf.set("telemark.segmentRows", "4000")
    found = quantile.select_ranks(df, ["k"], {"q50": 0.5, "q95": 0.95, "q0": 0.0, "q100": 1.0}).first()
    for name, q in (("q50", 50), ("q95", 95), ("q0", 0), ("q100", 100)):
        assert found[name] == pytest.approx(np.percentile(values, q), abs=1e-12)
    (counted,) = [t for t in written if "_c" in t.columns]
    assert counted.count() < 1_000  # of 20,000 distinct values


def test_segmented_fit_is_written(spark, small_segments):
    """A fit that is only planned is joined by shuffling all frames by stream."""
    frames = line(spark, [k * 33 * MS for k in range(200)])
    config = HeadTimestamp()
    fit = repair.robust_fit(frames, "i", "t", repair.nominal_period(frames, "t", config), config)
    assert "Aggregate" not in fit._jdf.queryExecution().executedPlan().toString()
    assert fit.first().anchor_count == 200
