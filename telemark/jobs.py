"""What a user runs: clean, resample, convert, audit, repair, inspect recordings.

Each job reads recordings, composes the operators and writes its results next to
reports.  ``python -m telemark <job> --help`` lists the parameters.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark import contract
from telemark.config import (
    Conversion,
    HeadTimestamp,
    OperatorConfig,
    PipelineConfig,
    SpikeRepair,
    TimestampQuality,
)
from telemark.functions.scalar import columns_with_prefix, to_ms, topic_category
from telemark.functions.sequence import track
from telemark.operators import conversion, exposure, images, motion, quality, repair, resample, shared_scan, spikes, timeline
from telemark.sources import cameras, dataset, mcap, mcap_sink, reports
from telemark.sources.durable import durable
from telemark.sources.episodes import missing_topics

CORRECTIONS = "timestamp_corrections"
MANIFEST = "cleaning_manifest"

# Limits of the quality report that no configuration table carries.
MAX_STATE_GAP_MS, MAX_ACTION_GAP_MS, MAX_IMAGE_GAP_MS = 30.0, 120.0, 70.0
IMAGE_SAMPLES = 24


def guard_output(source: str, target: str) -> None:
    """Results never go into the folder they are made from."""
    if target.rstrip("/") == source.rstrip("/") or target.startswith(source.rstrip("/") + "/"):
        raise ValueError("the output must not be the input folder or lie inside it")


def _stop_if_any(problems: DataFrame, text: str) -> None:
    found = problems.limit(20).collect()
    if found:
        raise ValueError(f"{text}: {[row.asDict() for row in found]}")


def _stream_of(rows: DataFrame, order: str = "record_index"):
    return track(rows, ["episode", "topic"], [order])


def payloads(rows: DataFrame) -> DataFrame:
    return mcap.fetch(rows, "source_file", "cdr_file_offset", "cdr_size")


def clean(
    spark: SparkSession, source: str, target: str, config: HeadTimestamp | None = None, *, overwrite: bool = False, dry_run: bool = False
) -> DataFrame:
    """Repair the head camera's header stamps; returns the correction table.

    All other messages are copied byte for byte.  Message order is kept.
    """
    guard_output(source, target)
    config = config or HeadTimestamp()
    raw = mcap.scan(spark, source)
    _stop_if_any(mcap.unpatchable(raw), "recordings with checksums cannot be rewritten")
    rows = durable(mcap.messages(raw))
    head = rows.filter(F.col("topic") == config.topic)
    _stop_if_any(missing_topics(rows, ["episode"], [config.topic]), "episodes without the camera")
    _stop_if_any(head.filter(F.col("header_time_ns").isNull()).select("episode").distinct(), "incomplete header stamps")
    line = track(head, ["episode", "topic"], ["topic_index"])
    repaired = repair.repair_timestamps(line, "topic_index", "header_time_ns", config).rows()
    repaired = durable(repaired)
    _stop_if_any(repair.unrepairable(line, repaired), "stamps that cannot be repaired")
    corrections = repair.correction_rows(repaired)
    if not dry_run:
        fixed = corrections.select(
            "episode", F.col("mcap_record_index").alias("record_index"), F.col("corrected_header_time_ns").alias("_new")
        )
        full = payloads(rows.join(fixed, ["episode", "record_index"], "left"))
        # A stamp that stays the same is written back unchanged.
        changed = full.filter(F.col("_new") != F.col("header_time_ns"))
        changed = changed.withColumn("data", mcap_sink.with_header_time("data", "header_time_ns", "_new"))
        same = full.filter(F.col("_new").isNull() | (F.col("_new") == F.col("header_time_ns")))
        out = same.unionByName(changed).withColumn("position", F.col("record_index"))
        mcap_sink.write_recordings(out, target, overwrite=overwrite)
        reports.write_csv(corrections, f"{target}/{CORRECTIONS}", overwrite=overwrite)
        summary = repair.repair_diagnostics(repaired, ["episode", "topic"])
        reports.write_json_lines(summary, f"{target}/{MANIFEST}", overwrite=overwrite)
        table = reports.markdown_table(summary.drop("topic"), [F.col("episode")])
        reports.write_text(f"{target}/cleaning_report.md", f"# Timestamp cleaning\n\n{table}")
    return corrections


def read_corrections(spark: SparkSession, cleaned: str) -> DataFrame | None:
    """The correction table of a cleaned folder; missing rows for changed frames are an error."""
    system, base = mcap.open_folder(cleaned)
    there = {name: system.get_file_info(f"{base}/{name}").type != mcap.fs.FileType.NotFound for name in (CORRECTIONS, MANIFEST)}
    if there[CORRECTIONS]:
        typed = spark.read.csv(f"{cleaned}/{CORRECTIONS}", header=True, inferSchema=False)
        numbers = {"mcap_record_index": "bigint", "header_time_ns": "bigint", "correction_ms": "double"}
        return typed.withColumns(
            {name: F.nullif(F.nullif(F.col(name), F.lit("")), F.lit("None")).try_cast(kind) for name, kind in numbers.items()}
        )
    if there[MANIFEST]:
        changed = spark.read.json(f"{cleaned}/{MANIFEST}").agg(F.sum("changed_frame_count")).first()[0]
        if changed:
            raise FileNotFoundError(f"{changed} stamps were cleaned but the correction table is missing below {cleaned}")
    return None


def resampled(spark: SparkSession, source: str, fps: float, topics: Sequence[str], *, require_cleaned: bool = False):
    """Messages, lineage samples and target mappings of a folder of recordings."""
    corrections = read_corrections(spark, source)
    if require_cleaned and corrections is None:
        raise ValueError(f"not a cleaned folder: {source}")
    rows = durable(mcap.messages(mcap.scan(spark, source, topics=topics)))
    _stop_if_any(missing_topics(rows, ["episode"], topics), "missing streams")
    line = _stream_of(rows.withColumn("time_ns", F.col("primary_time_ns")))
    _stop_if_any(resample.stream_violations(line, "time_ns"), "streams that cannot be aligned")
    samples = resample.source_samples(rows, corrections)
    timed = rows.join(
        samples.select("episode", F.col("mcap_record_index").alias("record_index"), "original_primary_time_ns"), ["episode", "record_index"]
    )
    line = _stream_of(timed.withColumn("time_ns", F.col("primary_time_ns")))
    mappings = resample.target_mappings(line, ["episode"], fps, "time_ns", "original_primary_time_ns", "topic_index")
    return rows, samples, durable(mappings)


def resample_recordings(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    fps: float = 20.0,
    topics: Sequence[str] = contract.REQUIRED_TOPICS,
    mode: str = "aligned",
    diagnostics: bool = True,
    require_cleaned: bool = False,
    overwrite: bool = False,
) -> DataFrame:
    """Write recordings at a fixed rate; returns the target mappings.

    ``aligned`` repeats the chosen payload at every target time, ``unique`` keeps
    each chosen message once with its own times.
    """
    if mode not in ("aligned", "unique"):
        raise ValueError("mode is aligned or unique")
    guard_output(source, target)
    rows, samples, mappings = resampled(spark, source, fps, topics, require_cleaned=require_cleaned)
    _stop_if_any(mcap.inconsistent_topics(rows), "topics whose type changes between files")
    held = rows.select(
        "episode", "topic", F.col("topic_index").alias("source_index"), "record_index", "schema_name", "schema_encoding",
        "schema_data", "message_encoding", "channel_metadata", "sequence", "log_time_ns", "publish_time_ns", "source_file",
        "cdr_file_offset", "cdr_size",
    )
    if mode == "unique":
        chosen = held.join(resample.unique_selection(mappings, ["episode", "topic"]), ["episode", "topic", "source_index"])
        line = track(chosen, ["episode"], ["log_time_ns", "record_index"])
        from telemark.functions.sequence import carry

        out = payloads(carry(line, number="position").rows())
    else:
        chosen = mappings.select("episode", "topic", "target_index", "target_time_ns", "source_index").join(
            held.drop("sequence", "log_time_ns", "publish_time_ns"), ["episode", "topic", "source_index"]
        )
        out = payloads(chosen).withColumns(
            {
                "sequence": F.col("target_index"),
                "log_time_ns": F.col("target_time_ns"),
                "publish_time_ns": F.col("target_time_ns"),
            }
        )
        place = F.array_position(F.array(*[F.lit(t) for t in topics]), F.col("topic")) - 1
        slots = len(topics) * 2 + 1
        out = out.withColumn("position", F.col("target_index") * slots + place * 2).select(*[c for c in mcap_sink.COLUMNS if c != "part"])
        if diagnostics:
            out = out.unionByName(_diagnostics(mappings, samples, fps, topics, slots))
    extra = {"resampling": {"mode": mode, "fps": str(fps), "header_policy": "source header kept"}}
    mcap_sink.write_recordings(out, target, name=f"{mode}_{fps:g}hz", overwrite=overwrite, metadata=extra)
    mappings.write.mode("overwrite" if overwrite else "errorifexists").parquet(f"{target}/mappings")
    samples.write.mode("overwrite" if overwrite else "errorifexists").parquet(f"{target}/samples")
    return mappings


def _diagnostics(mappings: DataFrame, samples: DataFrame, fps: float, topics: Sequence[str], slots: int) -> DataFrame:
    each = resample.diagnostic_metrics(mappings, samples, fps)
    place = F.array_position(F.array(*[F.lit(t) for t in topics]), F.col("source_topic")) * 2 - 1
    each = each.withColumns(
        {"position": F.col("target_index") * slots + place, "_m": F.create_map(F.lit("source_topic"), F.col("source_topic"))}
    ).drop("source_topic")
    targets = mappings.select("episode", "target_index", "target_time_ns").distinct()
    skew = resample.diagnostic_skew(resample.topic_pairs(mappings, ["episode"], topics), targets, fps)
    empty = F.create_map().cast("map<string,string>")
    skew = skew.withColumns({"position": F.col("target_index") * slots + (slots - 1), "_m": empty})
    both = each.unionByName(skew)
    kind = F.when(F.col("topic").endswith("/cross_stream"), "CrossStreamSkew").otherwise("ResamplingMetric")
    return both.select(
        "episode",
        "position",
        "topic",
        kind.alias("schema_name"),
        F.lit("jsonschema").alias("schema_encoding"),
        F.encode(F.lit(json.dumps({"type": "object"})), "utf-8").alias("schema_data"),
        F.lit("json").alias("message_encoding"),
        F.col("_m").alias("channel_metadata"),
        F.col("target_index").alias("sequence"),
        F.col("target_time_ns").alias("log_time_ns"),
        F.col("target_time_ns").alias("publish_time_ns"),
        F.encode("body", "utf-8").alias("data"),
    )


def analyze_resampling(
    mappings: DataFrame,
    samples: DataFrame,
    config: TimestampQuality | None = None,
    *,
    thresholds_ms: Sequence[float] = (10.0, 20.0, 33.333, 40.0, 60.0),
    topics: Sequence[str] = contract.REQUIRED_TOPICS,
) -> dict[str, DataFrame]:
    """Stream, pair and gap tables of a resampling run."""
    config = config or TimestampQuality()
    keys = ["episode", "topic"]
    timelines = {}
    for name in ("original", "cleaned"):
        timed = samples.select(*keys, "source_index", F.col(f"{name}_primary_time_ns").alias("time_ns"))
        timelines[name] = track(timed, keys, ["source_index"])
    parts = {name: timeline.gap_statistics(line, "time_ns", config) for name, line in timelines.items()}
    streams = resample.mapping_counters(mappings, samples, keys).withColumn("category", topic_category(F.col("topic")))
    for name, stats in parts.items():
        short = [F.col(c).alias(f"{name}_{c}") for c in ("nominal_period_ms", "nonpositive_count", "warning_gap_count", "fail_gap_count")]
        streams = streams.join(stats.select(*keys, *short), keys)
    residual = resample.residual_stats(mappings, keys, F.col("residual_ms"))
    streams = streams.join(residual, keys)
    corrected = samples.groupBy(*keys).agg(F.count_if(F.col("cleaning_correction_ms") != 0).alias("corrected_count"))
    gaps = [
        timeline.gap_events(line, "time_ns", "source_index", config).withColumn("timeline", F.lit(name))
        for name, line in timelines.items()
    ]
    pairs = resample.topic_pairs(mappings, ["episode"], topics)
    return {
        "streams": streams.join(corrected, keys),
        "pairs": resample.residual_stats(pairs, ["episode", "left_topic", "right_topic"], to_ms(F.col("skew_ns"))),
        "gap_events": gaps[0].unionByName(gaps[1]),
        "thresholds": resample.threshold_exceedance(mappings, keys, F.col("residual_ms"), thresholds_ms),
        "raw_residuals": resample.residual_stats(mappings, keys, F.col("raw_to_target_residual_ms")),
        "residual_histogram": reports.histogram(mappings, keys, F.col("residual_ms")),
    }


def convert(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    annotations: DataFrame | None = None,
    task: str = "",
    config: Conversion | None = None,
    overwrite: bool = False,
    dry_run: bool = False,
) -> conversion.EpisodePlan:
    """Convert recordings to a training dataset.

    Everything is planned and checked first; any rejected episode stops the job
    before the first byte is written.
    """
    config = config or Conversion()
    rows = durable(mcap.messages(mcap.scan(spark, source, topics=contract.REQUIRED_TOPICS)))
    plan = conversion.plan_episodes(rows, annotations, config)
    _stop_if_any(plan.rejected, "episodes that cannot be converted")
    tasks = plan.spans.select("episode")
    if annotations is not None:
        tasks = tasks.join(annotations.select("episode", "task"), "episode", "left")
        tasks = tasks.withColumn("task", F.btrim(F.coalesce("task", F.lit(task))))
    else:
        tasks = tasks.withColumn("task", F.lit(task))
    _stop_if_any(tasks.filter(F.length("task") == 0), "episodes without a task")
    if not dry_run:
        dataset.write_dataset(plan.frames, target, fps=config.fps, tasks=tasks, overwrite=overwrite)
    return plan


def audit_joints(spark: SparkSession, source: str, operators: OperatorConfig | None = None) -> dict[str, DataFrame]:
    """Structure, clock and motion audit of the raw joint streams."""
    operators = operators or OperatorConfig()
    topics = {contract.FOLLOWER_JOINTS: contract.FOLLOWER_JOINT_NAMES, contract.LEADER_JOINTS: contract.LEADER_JOINT_NAMES}
    rows = durable(mcap.messages(mcap.scan(spark, source, topics=list(topics))))
    structure = motion.structural_audit(rows, ["episode", "topic"], topics)
    valid = structure.filter(F.col("structural_status") == "valid").select("episode", "topic")
    good = rows.join(valid, ["episode", "topic"]).withColumn("arm", columns_with_prefix("arm_"))
    timing = TimestampQuality()
    result = {"structure": structure}
    parts: dict[str, list[DataFrame]] = {}
    for topic, signal, floor in (
        (contract.FOLLOWER_JOINTS, operators.joint_motion.state, timing.state_gap_floor_ms),
        (contract.LEADER_JOINTS, operators.joint_motion.action, timing.action_gap_floor_ms),
    ):
        line = track(good.filter(F.col("topic") == topic), ["episode", "topic"], ["topic_index"])
        between = lambda later, earlier: (later - earlier) / F.lit(1e9)
        cells = motion.joint_cells(line, "arm", "topic_index", between, "header_time_ns", radians=False)
        flagged = motion.audit_flags(cells, signal, operators.joint_motion)
        clock = motion.audit_gaps(line, "header_time_ns", "topic_index", F.lit(floor), timing)
        keys = ["episode", "topic"]
        for name, table in {
            "clock": clock,
            "status": motion.audit_summary(flagged, clock, keys),
            "joints": motion.audit_joints(flagged, keys),
            "events": motion.audit_events(flagged, keys, signal, operators.joint_motion),
            "largest_step": motion.largest_step(cells, keys),
        }.items():
            parts.setdefault(name, []).append(table)
    return {**result, **{name: a.unionByName(b) for name, (a, b) in parts.items()}}


def repair_spikes(
    spark: SparkSession,
    source: str,
    target: str | None,
    config: SpikeRepair | None = None,
    *,
    topic: str = contract.FOLLOWER_JOINTS,
    prefix: str = "arm_",
    overwrite: bool = False,
) -> dict[str, DataFrame]:
    """Repair short joint spikes; without a target nothing is written."""
    config = config or SpikeRepair()
    rows = durable(mcap.messages(mcap.scan(spark, source)))
    _stop_if_any(missing_topics(rows, ["episode"], [topic]), "episodes without the joint stream")
    joints = rows.filter(F.col("topic") == topic)
    line = track(joints, ["episode"], ["topic_index"])
    _stop_if_any(resample.stream_violations(line, "header_time_ns"), "joint clocks that do not advance")
    readable = F.col("values").isNotNull() & F.col("names").isNotNull() & ~F.exists("values", lambda x: x.isNull() | ~conversion.is_finite(x))
    _stop_if_any(joints.filter(~readable).select("episode", "topic_index"), "joint messages that do not decode or are not finite")
    names = joints.groupBy("episode").agg(F.count_distinct("names").alias("orders"), F.first("names").alias("names"))
    _stop_if_any(names.filter(F.col("orders") > 1).select("episode"), "joint names that change")
    seconds = F.col("header_time_ns").cast("double") / F.lit(1e9)
    edges = spikes.joint_edges(line, "values", "topic_index", seconds, config)
    named = edges.join(names.select("episode", "names"), "episode").withColumn("_name", F.get("names", F.col("joint")))
    edges = named.filter(F.col("_name").startswith(prefix)).drop("names", "_name")
    extent = joints.withColumn("_s", seconds).groupBy("episode").agg(F.count("*").alias("frames"), F.min("_s").alias("origin_s"))
    runs = durable(spikes.spike_runs(edges, extent, ["episode"], config))
    cells = spikes.repaired_cells(runs, ["episode"], config)
    status = spikes.spike_status(runs, cells, extent, ["episode"])
    if target is not None:
        guard_output(source, target)
        fixed = spikes.corrected_frames(
            joints.select("episode", "topic_index", "record_index", "values"), cells, ["episode"], "values", "topic_index"
        )
        full = payloads(rows.join(fixed.select("episode", "record_index", F.col("values").alias("_new")), ["episode", "record_index"], "left"))
        changed = full.filter(F.col("_new") != F.col("values"))
        changed = changed.withColumn("data", mcap_sink.with_positions("data", "values", "_new"))
        same = full.filter(F.col("_new").isNull() | (F.col("_new") == F.col("values")))
        out = same.unionByName(changed).withColumn("position", F.col("record_index"))
        mcap_sink.write_recordings(out, target, overwrite=overwrite)
        reports.write_csv(runs, f"{target}/joint_events", overwrite=overwrite)
    return {"events": runs, "values": cells, "status": status, "jumps": spikes.merged_jumps(edges, ["episode"])}


def inspect_quality(
    spark: SparkSession,
    source: str,
    *,
    annotations: DataFrame | None = None,
    config: PipelineConfig | None = None,
    task: str = "",
    decode=None,
) -> dict[str, DataFrame]:
    """The composite quality report: clocks, values, residuals, motion, labels, verdict.

    With ``decode`` (one encoded picture to pixels) an even sample of every
    camera is read as well.
    """
    config = config or PipelineConfig()
    raw = mcap.scan(spark, source)
    rows = durable(mcap.messages(raw).withColumn("time_ns", conversion.converter_time()))
    keys = ["episode", "topic"]
    infinite = float("inf")
    open_limits = Conversion(
        fps=config.conversion.fps,
        max_image_delta_ms=infinite,
        max_state_delta_ms=infinite,
        max_action_delta_ms=infinite,
        gripper_scale=config.conversion.gripper_scale,
    )
    plan = conversion.plan_episodes(rows, annotations, open_limits)
    sortable = rows.filter(F.col("time_ns").isNotNull())
    clocks = timeline.timestamp_metrics(track(sortable, keys, ["time_ns", "record_index"]), "time_ns")
    values = quality.array_metrics(rows.filter(F.col("values").isNotNull()), keys, "values")
    numeric = clocks.join(
        values.groupBy(*keys).agg(F.sum("nan_count").alias("nan_count"), F.sum("inf_count").alias("inf_count")), keys
    )
    topic = F.col("topic")
    limit = F.when(topic.isin(*contract.ACTION_TOPICS), MAX_ACTION_GAP_MS).otherwise(MAX_STATE_GAP_MS)
    shots = clocks.filter(topic.isin(*contract.IMAGE_TOPICS))
    pictures = {}
    if decode is None:
        shots = shots.withColumns({"decode_failures": F.lit(0), "shapes": F.lit(1)})
    else:
        pointers = rows.filter(F.col("image").isNotNull()).select(*keys, "topic_index", "image")
        sampled = images.uniform_sample(pointers, keys, "topic_index", IMAGE_SAMPLES)
        pixels = durable(cameras.decoded(sampled, decode))
        shape = F.struct("image.height", "image.width", "image.nChannels")
        counted = pixels.groupBy(*keys).agg(
            F.count("decode_error").alias("decode_failures"),
            F.count_distinct(F.when(F.col("image").isNotNull(), shape)).alias("shapes"),
        )
        shots = shots.join(counted, keys)
        measured = images.sample_metrics(pixels.filter(F.col("image").isNotNull())).drop("image", "decode_error")
        loaded = mcap.fetch(sampled.select(*keys, "image.*"), "path", "offset", "size")
        pictures = {
            "picture_samples": measured,
            "picture_summary": images.sample_summary(measured, keys),
            "picture_hashes": images.hash_duplicates(loaded, keys, F.col("data")),
        }
    frames = track(plan.frames.withColumns({"state": F.col("`observation.state`")}), ["episode"], ["frame_index"])
    steps = quality.action_steps(frames, "action", "frame_index")
    tracked = quality.tracking_cells(plan.frames.withColumn("state", F.col("`observation.state`")), ["episode"], "state", "action")
    movement = quality.action_quality(steps, ["episode"], config.conversion.max_action_step_deg).join(
        quality.tracking_totals(tracked, ["episode"]), "episode"
    )
    labels = rows.select("episode").distinct()
    if annotations is not None:
        labels = labels.join(annotations.select("episode", "task", "success"), "episode", "left")
        labels = labels.withColumn("task", F.coalesce("task", F.lit(task)))
    else:
        labels = labels.withColumns({"task": F.lit(task), "success": F.lit(None).cast("boolean")})
    limits = {"state": config.conversion.max_state_delta_ms, "action": config.conversion.max_action_delta_ms}
    residual_rules = [
        F.when(F.col("stream_group") == group, quality.residual_rule(f"{group}_alignment_residual", value)) for group, value in limits.items()
    ]
    residual_rules.append(
        F.when(~F.col("stream_group").isin(*limits), quality.residual_rule("image_alignment_residual", config.conversion.max_image_delta_ms))
    )
    subject = F.col("topic")
    tcp = quality.tcp_streams(rows)
    numbers = numeric.filter(~topic.isin(*contract.IMAGE_TOPICS))
    risks = quality.apply_rules(numbers, ["episode"], quality.numeric_rules(limit), subject)
    for more in (
        quality.apply_rules(shots, ["episode"], quality.camera_rules(MAX_IMAGE_GAP_MS, topic == contract.HEAD_CAMERA), subject),
        quality.apply_rules(plan.residuals, ["episode"], residual_rules, F.col("stream_group")),
        quality.apply_rules(movement, ["episode"], quality.motion_rules(config.joint_motion.max_tracking_p95_deg), F.lit("arm")),
        quality.apply_rules(labels, ["episode"], quality.label_rules(), F.lit("labels")),
        quality.apply_rules(tcp, ["episode"], [quality.tcp_rule()], F.lit("tool")),
        quality.apply_rules(plan.rejected, ["episode"], [quality.failure_rule(F.col("reason"))], F.lit("conversion")),
    ):
        risks = risks.unionByName(more)
    episodes = quality.roll_up(risks, ["episode"])
    return {
        "risks": risks,
        "episodes": episodes,
        "run": quality.run_status(episodes),
        "clocks": clocks,
        "values": values,
        "residuals": plan.residuals,
        "movement": movement,
        "largest_jumps": quality.largest_jumps(steps, ["episode"]),
        "tool": tcp,
        **pictures,
        "encoded_sizes": images.encoded_sizes(
            rows.filter(F.col("image").isNotNull()).select(*keys, F.col("image.size").alias("size")), keys, "size"
        ),
    }


def inspect_exposure(
    spark: SparkSession, frames: DataFrame, operators: OperatorConfig | None = None, *, keys: Sequence[str] = ("episode", "camera"), frame: str = "frame_index"
) -> dict[str, DataFrame]:
    """Exposure of decoded frames (Spark image struct in ``image``), per camera."""
    config = (operators or OperatorConfig()).exposure
    measured = durable(exposure.image_luminance_metrics(frames, "image", config).drop("image"))
    return _judged_exposure(measured, keys, frame, operators)


def _judged_exposure(measured: DataFrame, keys: Sequence[str], frame: str, operators: OperatorConfig | None) -> dict[str, DataFrame]:
    config = (operators or OperatorConfig()).exposure
    line = track(measured, list(keys), [frame]).derive(exposure.candidate_flags(config))
    confirmed = exposure.confirmed_frames(line, frame, config)
    origin = [c for c in ("timestamp_s", "header_time_ns", "log_time_ns") if c in measured.columns]
    return {
        "frames": confirmed,
        "segments": exposure.exposure_segments(confirmed, list(keys), frame, origin),
        "cameras": exposure.exposure_summary(confirmed, list(keys)),
        "status": exposure.exposure_status(confirmed, [keys[0]]),
    }


def inspect_cameras(
    spark: SparkSession,
    source: str,
    decode,
    operators: OperatorConfig | None = None,
    *,
    episodes: Sequence[str] = (),
    max_frames: int | None = None,
) -> dict[str, DataFrame]:
    """Exposure of raw recordings, camera by camera.

    ``decode`` reads one encoded picture.  Pictures it cannot read are listed in
    ``failures``; the episodes around them are still judged.
    """
    rows = mcap.messages(mcap.scan(spark, source, topics=contract.IMAGE_TOPICS, episodes=episodes))
    shots = durable(cameras.camera_frames(rows, max_frames=max_frames))
    _stop_if_any(missing_topics(shots.withColumn("topic", F.col("camera")), ["episode"], contract.IMAGE_TOPICS), "missing cameras")
    pixels = cameras.decoded(shots, decode)
    measured = durable(exposure.image_luminance_metrics(pixels.filter(F.col("image").isNotNull()), "image", (operators or OperatorConfig()).exposure).drop("image", "decode_error"))
    read = measured.select("episode", "camera", "frame_index")
    failures = shots.join(read, ["episode", "camera", "frame_index"], "left_anti").select("episode", "camera", "frame_index", "source_file")
    return {**_judged_exposure(measured, ["episode", "camera"], "frame_index", operators), "failures": failures}


def jump_evidence(
    spark: SparkSession,
    source: str,
    config: SpikeRepair | None = None,
    *,
    topic: str = contract.LEADER_JOINTS,
    joints: int = contract.ARM_JOINTS,
    prefix: str = "arm_",
    normal_window_s: float = 3.0,
    abnormal_window_s: float = 1.4,
) -> dict[str, DataFrame]:
    """Per episode: all jumps, the strongest one, a window around it, a clean
    reference window, the samples of both, and the head pictures closest to them."""
    config = config or SpikeRepair(max_step_deg=25.0, max_velocity_deg_s=500.0)
    rows = durable(mcap.messages(mcap.scan(spark, source, topics=[topic, contract.HEAD_CAMERA])))
    states = rows.filter(F.col("topic") == topic).withColumn("arm", columns_with_prefix(prefix))
    origin = states.groupBy("episode").agg(F.min_by("header_time_ns", "topic_index").alias("_origin"))
    timed = states.join(origin, "episode").withColumn("time_s", (F.col("header_time_ns") - F.col("_origin")) / F.lit(1e9))
    line = track(timed.select("episode", "topic_index", "header_time_ns", "time_s", "arm"), ["episode"], ["topic_index"])
    seconds = F.col("time_s")
    extent = line.df.groupBy("episode").agg(F.min("time_s").alias("origin_s"), F.max("time_s").alias("last_s"))
    edges = spikes.joint_edges(line, "arm", "topic_index", seconds, config)
    jumps = durable(spikes.merged_jumps(edges, ["episode"]))
    strongest = spikes.strongest_jump(jumps, ["episode"])
    abnormal = spikes.abnormal_window(line.df, strongest, extent, ["episode"], "topic_index", seconds, abnormal_window_s)
    runs = spikes.clean_runs(line, "arm", "topic_index", seconds, joints, config)
    normal = spikes.normal_window(line, runs, "arm", "topic_index", seconds, joints, normal_window_s)
    windows = durable(
        abnormal.withColumn("window", F.lit("jump")).unionByName(normal.drop("motion_deg").withColumn("window", F.lit("normal")))
    )
    samples = line.df.join(windows, "episode").filter(F.col("topic_index").between(F.col("start_frame"), F.col("end_frame")))
    starts = strongest.select("episode", F.col("sample_start").alias("topic_index"), F.lit("jump").alias("window")).unionByName(
        normal.select("episode", F.col("start_frame").alias("topic_index"), F.lit("normal").alias("window"))
    )
    probes = starts.join(line.df.select("episode", "topic_index", F.col("header_time_ns").alias("probe_ns")), ["episode", "topic_index"])
    head = rows.filter(F.col("topic") == contract.HEAD_CAMERA).select("episode", F.col("topic_index").alias("image_index"), F.col("header_time_ns").alias("image_ns"))
    windowed = head.join(probes.select("episode", "window").distinct(), "episode")
    pictures = spikes.nearest_probe(probes.drop("topic_index"), windowed, ["episode", "window"], "probe_ns", "image_ns", "image_index")
    return {"jumps": jumps, "strongest": strongest, "windows": windows, "samples": samples.drop("start_frame", "end_frame"), "pictures": pictures}


def inspect_motion(frames: DataFrame, names: Sequence[str], vector: str, limits: DataFrame, signal, operators: OperatorConfig | None = None) -> dict[str, DataFrame]:
    """Joint motion of a converted dataset (``episode_index``, ``frame_index``, ``timestamp``, radians)."""
    config = (operators or OperatorConfig()).joint_motion
    keys = ["episode_index"]
    rows = frames.withColumn("_arm", F.slice(F.col(f"`{vector}`"), 1, len(names)).cast("array<double>"))
    line = track(rows.select(*keys, "frame_index", F.col("timestamp").cast("double").alias("timestamp"), "_arm"), keys, ["frame_index"])
    _stop_if_any(motion.motion_frames_problem(line, "_arm", "timestamp"), "episodes that cannot be judged")
    cells = motion.joint_cells(line, "_arm", "frame_index", lambda a, b: a - b, "timestamp", radians=True)
    events = motion.motion_events(cells, limits, keys, signal, config)
    return {
        "events": events,
        "status": motion.motion_status(events, line.df, keys),
        "joints": motion.joint_distributions(cells, keys),
    }


def inspect_converted(
    spark: SparkSession,
    root: str,
    operators: OperatorConfig | None = None,
    *,
    chosen: Sequence[str] = ("motion", "action"),
    vector: str = "action",
    urdf: str | None = None,
    joints: int = contract.ARM_JOINTS,
    max_step_deg: float = 25.0,
    episodes: Sequence[int] | None = None,
) -> dict[str, dict[str, DataFrame]]:
    """Chosen operators on a converted dataset, all from one scan of its frames; ``urdf`` is a robot description."""
    config = operators or OperatorConfig()
    keys = ["episode_index"]
    if episodes is not None:
        dataset.read_episodes(spark, root, episodes)
    frames = dataset.read_frames(spark, root, [vector], episodes)
    _stop_if_any(dataset.broken_episodes(frames), "episodes with gaps in frames or clock")
    names = dataset.feature_names(dataset.read_json(f"{root}/meta/info.json"), vector, joints)[:joints]
    arm = F.slice(F.col(f"`{vector}`"), 1, joints).cast("array<double>")
    line = track(frames.select(*keys, "frame_index", F.col("timestamp").cast("double").alias("time_s"), arm.alias("arm")), keys, ["frame_index"])
    _stop_if_any(motion.motion_frames_problem(line, "arm", "time_s"), "episodes that cannot be judged")
    signal = config.joint_motion.action if vector == "action" else config.joint_motion.state
    settings = {
        "motion": {"vector": "arm", "time": "time_s", "limits": motion.urdf_limits(spark, urdf, names, signal), "signal": signal, "config": config.joint_motion},
        "action": {"vector": "arm", "limit_deg": max_step_deg, "joints": joints},
    }
    made = shared_scan.chosen({name: settings.get(name, {}) for name in chosen})
    return shared_scan.shared_scan(line, "frame_index", made)
