"""Joint motion: steps, velocity, acceleration, spikes, limits and audit.

Frames stay one row each while the neighbours are looked up, so only narrow
vectors are shuffled; joints are unfolded afterwards, inside the same task.
"""

from __future__ import annotations

from collections.abc import Sequence
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark.config import JointMotion, JointSignal, TimestampQuality
from telemark.functions.quantile import summarise
from telemark.functions.scalar import canonical_joint, is_finite, is_infinite
from telemark.functions.sequence import Track, carry

QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p99_9": 0.999, "max": 1.0}
METRICS = ("step_deg", "velocity_deg_s", "acceleration_deg_s2")
EVENT_KINDS = ("position_limit", "step_discontinuity", "velocity_limit", "acceleration_limit", "single_frame_spike")


def joint_cells(
    frames: Track,
    values: str,
    frame: str,
    seconds_between,
    time: str,
    *,
    radians: bool,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per frame and joint with the derivatives that end on it.

    ``seconds_between(later, earlier)`` turns two values of ``time`` into seconds.
    ``entry``/``exit``/``recovery`` describe the three frames around this one.
    """
    looked = look_around(frames, values, time)
    return unfolded_cells(looked.df, frames.keys, values, frame, seconds_between, time, radians=radians, keep=keep)


def look_around(frames: Track, values: str, time: str) -> Track:
    """Vectors and times of the two frames before each frame and of the one after."""
    return carry(
        frames,
        prev={"_v1": F.col(values), "_t1": F.col(time)},
        prev2={"_v2": F.col(values), "_t2": F.col(time)},
        next={"_vn": F.col(values), "_tn": F.col(time)},
    )


def unfolded_cells(
    looked: DataFrame, keys: Sequence[str], values: str, frame: str, seconds_between, time: str, *, radians: bool, keep: Sequence[str] = ()
) -> DataFrame:
    """Cells of frames that know their neighbours (see ``joint_cells``)."""
    # Neighbours are missing at the ends, so they are looked up by position.
    cells = looked.select(
        *keys,
        *keep,
        F.col(frame).alias("frame"),
        F.col(time).alias("_t"),
        *("_t1", "_t2", "_v1", "_v2", "_vn"),
        F.posexplode(values).alias("joint", "_v"),
    )
    degrees = F.degrees if radians else (lambda x: x)
    v = F.col("_v")
    v1, v2, vn = (F.get(F.col(name), F.col("joint")) for name in ("_v1", "_v2", "_vn"))
    dt, dt1 = seconds_between(F.col("_t"), F.col("_t1")), seconds_between(F.col("_t1"), F.col("_t2"))
    velocity, velocity1 = (v - v1) / F.nullif(dt, F.lit(0.0)), (v1 - v2) / F.nullif(dt1, F.lit(0.0))
    acceleration = (velocity - velocity1) / F.nullif((dt1 + dt) / 2.0, F.lit(0.0))
    return cells.select(
        *keys,
        *keep,
        "frame",
        F.col("_t").alias("time"),
        "joint",
        v.alias("value"),
        v1.alias("previous"),
        degrees(v).alias("position_deg"),
        degrees(v - v1).alias("signed_step_deg"),
        dt.alias("dt_s"),
        degrees(F.abs(v - v1)).alias("step_deg"),
        degrees(F.abs(velocity)).alias("velocity_deg_s"),
        degrees(F.abs(acceleration)).alias("acceleration_deg_s2"),
        F.when(vn.isNotNull(), degrees(F.abs(v - v1))).alias("entry_deg"),
        F.when(v1.isNotNull(), degrees(F.abs(vn - v))).alias("exit_deg"),
        degrees(F.abs(vn - v1)).alias("recovery_deg"),
    )


def motion_frames_problem(frames: Track, values: str, time: str) -> DataFrame:
    """Episodes the motion operator refuses: too short, stalled clock, non-finite values."""
    looked = carry(frames, prev={"_t1": F.col(time)}).df
    bad_value = F.exists(F.col(values), lambda x: ~is_finite(x))
    counts = looked.groupBy(*frames.keys).agg(
        F.count("*").alias("frames"),
        F.count_if(F.col(time) <= F.col("_t1")).alias("stalled"),
        F.count_if(bad_value).alias("non_finite"),
    )
    reason = (
        F.when(F.col("non_finite") > 0, "non-finite values")
        .when(F.col("frames") < 3, "fewer than three frames")
        .when(F.col("stalled") > 0, "non-positive timestamp step")
    )
    return counts.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def urdf_limits(
    spark: SparkSession, text: str | None, joint_names: Sequence[str], signal: JointSignal
) -> DataFrame:
    """Limits per joint index, matched to the robot description by canonical name.

    A robot has a fixed handful of joints, so this is a dimension of proven size.
    """
    names = spark.createDataFrame([(i, n) for i, n in enumerate(joint_names)], "joint int, joint_name string")
    fallback = F.radians(F.lit(float(signal.fallback_max_velocity_deg_s)))
    if text is None:
        return names.select(
            "joint", "joint_name", F.lit(float("-inf")).alias("lower_rad"), F.lit(float("inf")).alias("upper_rad"), fallback.alias("max_velocity_rad_s")
        )
    rows = []
    for joint in ElementTree.fromstring(text).findall("joint"):
        limit = joint.find("limit")
        if limit is not None:
            number = {k: float(v) for k, v in limit.attrib.items() if k in ("lower", "upper", "velocity")}
            rows.append((joint.attrib["name"], number.get("lower"), number.get("upper"), number.get("velocity")))
    described = spark.createDataFrame(rows, "name string, lower double, upper double, velocity double")
    described = described.withColumn("_key", canonical_joint(F.col("name"))).withColumn("_known", F.lit(True))
    return match_limits(names, described, fallback)


def match_limits(names: DataFrame, described: DataFrame, fallback: Column) -> DataFrame:
    both = F.col("lower").isNotNull() & F.col("upper").isNotNull()
    joined = names.withColumn("_key", canonical_joint(F.col("joint_name"))).join(described, "_key", "left")
    known = F.coalesce("_known", F.lit(False))
    checked = F.when(known, F.col("joint")).otherwise(
        F.raise_error(F.concat(F.lit("no limits for joint "), F.col("joint_name"))).cast("int")
    )
    return joined.select(
        checked.alias("joint"),
        "joint_name",
        F.when(both, F.col("lower")).otherwise(float("-inf")).alias("lower_rad"),
        F.when(both, F.col("upper")).otherwise(float("inf")).alias("upper_rad"),
        F.when(F.col("velocity") > 0, F.col("velocity")).otherwise(fallback).alias("max_velocity_rad_s"),
    )


def _event(kind: str, when: Column, severity, value: Column, threshold: Column, unit: str, recovery: Column | None = None):
    return F.when(
        when,
        F.struct(
            F.lit(kind).alias("kind"),
            (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
            value.alias("value"),
            threshold.cast("double").alias("threshold"),
            F.lit(unit).alias("unit"),
            (F.lit(None).cast("double") if recovery is None else recovery).alias("recovery_error_deg"),
        ),
    )


def motion_events(
    cells: DataFrame, limits: DataFrame, keys: Sequence[str], signal: JointSignal, config: JointMotion
) -> DataFrame:
    """All rule hits; one cell can raise several kinds."""
    cells = cells.join(F.broadcast(limits), "joint")
    slack = F.radians(F.lit(float(config.position_limit_tolerance_deg)))
    lower, upper = F.col("lower_rad"), F.col("upper_rad")
    fastest = F.degrees("max_velocity_rad_s")
    nearly = fastest * config.velocity_warning_ratio
    hardest = F.lit(signal.max_acceleration_deg_s2)
    nearly_hard = F.lit(signal.max_acceleration_deg_s2 * config.acceleration_warning_ratio)
    velocity, acceleration = F.col("velocity_deg_s"), F.col("acceleration_deg_s2")
    too_fast, too_hard = velocity > fastest, acceleration > hardest
    entry, leave, recovery = F.col("entry_deg"), F.col("exit_deg"), F.col("recovery_deg")
    hits = F.array(
        _event(
            "position_limit",
            (F.col("value") < lower - slack) | (F.col("value") > upper + slack),
            "fail",
            F.col("position_deg"),
            F.degrees(F.when(F.col("value") < lower, lower).otherwise(upper)),
            "deg",
        ),
        _event(
            "step_discontinuity",
            F.col("step_deg") > signal.max_step_deg,
            "warning",
            F.col("step_deg"),
            F.lit(signal.max_step_deg),
            "deg",
        ),
        _event(
            "velocity_limit",
            velocity > nearly,
            F.when(too_fast, "fail").otherwise("warning"),
            velocity,
            F.when(too_fast, fastest).otherwise(nearly),
            "deg/s",
        ),
        _event(
            "acceleration_limit",
            acceleration > nearly_hard,
            F.when(too_hard, "fail").otherwise("warning"),
            acceleration,
            F.when(too_hard, hardest).otherwise(nearly_hard),
            "deg/s^2",
        ),
        _event(
            "single_frame_spike",
            (entry >= config.spike_min_step_deg)
            & (leave >= config.spike_min_step_deg)
            & (recovery <= config.spike_recovery_deg),
            "fail",
            F.greatest(entry, leave),
            F.lit(config.spike_min_step_deg),
            "deg",
            recovery,
        ),
    )
    rows = cells.select(
        *keys,
        F.col("frame").alias("frame_index"),
        F.col("time").alias("timestamp_s"),
        F.col("joint").alias("joint_index"),
        "joint_name",
        F.explode(F.array_compact(hits)).alias("_e"),
    )
    return rows.select(*keys, "frame_index", "timestamp_s", "joint_index", "joint_name", "_e.*")


def event_counts(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    return events.groupBy(*keys, "kind", "severity").agg(F.count("*").alias("events"))


def motion_status(events: DataFrame, frames: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Verdict per episode, also for episodes without any event."""
    counted = events.groupBy(*keys).agg(
        F.count_if(F.col("severity") == "fail").alias("fail_event_count"),
        F.count_if(F.col("severity") == "warning").alias("warning_event_count"),
        *[F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in EVENT_KINDS],
    )
    everything = frames.groupBy(*keys).agg(F.count("*").alias("frame_count"))
    joined = everything.join(counted, list(keys), "left").fillna(0)
    status = F.when(F.col("fail_event_count") > 0, "fail").when(F.col("warning_event_count") > 0, "warning")
    return joined.withColumn("status", status.otherwise("pass"))


def joint_distributions(cells: DataFrame, keys: Sequence[str], *, bound: int | None = None) -> DataFrame:
    """Position range and the quantiles of the three motion metrics per joint."""
    short = {"step_deg": "step", "velocity_deg_s": "velocity", "acceleration_deg_s2": "acceleration"}
    wanted = {
        metric: (F.col(metric), {f"{short[metric]}_{name}": q for name, q in QUANTILES.items()}) for metric in METRICS
    }
    plain = [F.min("position_deg").alias("min_deg"), F.max("position_deg").alias("max_deg")]
    return summarise(cells, [*keys, "joint"], plain, wanted, bound=bound)


def structural_audit(messages: DataFrame, keys: Sequence[str], expected: dict[str, Sequence[str]]) -> DataFrame:
    """Shape, name and value problems of raw joint messages, per stream.

    ``expected`` maps a topic to the joint names it must carry.
    """
    wanted = F.create_map(*[x for t, n in expected.items() for x in (F.lit(t), F.array(*map(F.lit, n)))])
    first = messages.groupBy(*keys).agg(F.min_by("names", "topic_index").alias("raw_names"))
    rows = messages.join(first, list(keys))
    counted = rows.groupBy(*keys).agg(
        F.first("raw_names").alias("raw_names"),
        F.count("*").alias("sample_count"),
        F.count_if(F.col("names").isNull() | F.col("values").isNull()).alias("undecodable"),
        F.count_if(~F.col("names").eqNullSafe(F.col("raw_names"))).alias("name_order_changes"),
        F.count_if(F.size("values") != F.size("names")).alias("shape_mismatches"),
        F.count_if(F.col("header_time_ns").isNull()).alias("missing_headers"),
        F.sum(F.size(F.filter("values", lambda x: F.isnan(x) | is_infinite(x)))).alias("nonfinite_values"),
    )
    should = F.try_element_at(wanted, F.col(keys[-1]))
    arm = F.filter("raw_names", lambda n: n.startswith("arm_"))
    counted = counted.withColumns(
        {
            "duplicate_names": F.size("raw_names") - F.size(F.array_distinct("raw_names")),
            "missing_arm_names": F.array_except(should, F.col("raw_names")),
            "unexpected_arm_names": F.array_except(arm, should),
        }
    )
    broken = (
        (F.col("undecodable") > 0)
        | (F.col("name_order_changes") > 0)
        | (F.col("shape_mismatches") > 0)
        | (F.col("missing_headers") > 0)
        | (F.col("nonfinite_values") > 0)
        | (F.col("duplicate_names") > 0)
        | (F.size("missing_arm_names") > 0)
        | (F.size("unexpected_arm_names") > 0)
        | (F.col("sample_count") < 3)
    )
    return counted.withColumn("structural_status", F.when(broken, "invalid").otherwise("valid"))


def audit_flags(cells: DataFrame, signal: JointSignal, config: JointMotion) -> DataFrame:
    """The audit's reading of each cell; ``frame`` is where a derivative ends."""
    step, velocity, acceleration = F.col("step_deg"), F.col("velocity_deg_s"), F.col("acceleration_deg_s2")
    fast, hard = signal.fallback_max_velocity_deg_s, signal.max_acceleration_deg_s2
    flags = {
        "step_over": step > signal.max_step_deg,
        "velocity_over": velocity > fast,
        "velocity_near": (velocity > fast * config.velocity_warning_ratio) & (velocity <= fast),
        "acceleration_over": acceleration > hard,
        "acceleration_near": (acceleration > hard * config.acceleration_warning_ratio) & (acceleration <= hard),
        "spike": (F.col("entry_deg") >= config.spike_min_step_deg)
        & (F.col("exit_deg") >= config.spike_min_step_deg)
        & (F.col("recovery_deg") <= config.spike_recovery_deg),
    }
    flagged = cells.withColumns({name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()})
    return flagged.withColumn("jump", F.col("step_over") | F.col("velocity_over"))


def audit_events(flagged: DataFrame, keys: Sequence[str], signal: JointSignal, config: JointMotion) -> DataFrame:
    """Audit events with the frames they lie between."""
    fast, hard = signal.fallback_max_velocity_deg_s, signal.max_acceleration_deg_s2
    frame = F.col("frame")

    def event(kind, when, severity, start, end, value, threshold):
        return F.when(
            when,
            F.struct(
                F.lit(kind).alias("kind"),
                (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
                start.alias("from_frame"),
                end.alias("to_frame"),
                value.alias("value"),
                threshold.alias("threshold"),
            ),
        )

    over = F.col("acceleration_over")
    hits = F.array(
        event("joint_jump", F.col("jump"), "review", frame - 1, frame, F.col("step_deg"), F.lit(signal.max_step_deg)),
        event(
            "velocity_near_limit",
            F.col("velocity_near"),
            "warning",
            frame - 1,
            frame,
            F.col("velocity_deg_s"),
            F.lit(fast * config.velocity_warning_ratio),
        ),
        event(
            "acceleration",
            over | F.col("acceleration_near"),
            F.when(over, "review").otherwise("warning"),
            frame - 2,
            frame,
            F.col("acceleration_deg_s2"),
            F.when(over, F.lit(hard)).otherwise(F.lit(hard * config.acceleration_warning_ratio)),
        ),
        event(
            "single_frame_spike",
            F.col("spike"),
            "review",
            frame - 1,
            frame + 1,
            F.greatest("entry_deg", "exit_deg"),
            F.lit(config.spike_min_step_deg),
        ),
    )
    return flagged.select(*keys, "joint", F.explode(F.array_compact(hits)).alias("_e")).select(*keys, "joint", "_e.*")


def audit_joints(flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    value = F.col("value")
    return flagged.groupBy(*keys, "joint").agg(
        F.min(value).alias("min_deg"),
        F.max(value).alias("max_deg"),
        F.stddev_pop(value).alias("std_deg"),
        (F.max(value) - F.min(value) < 1e-8).alias("constant"),
        F.max("step_deg").alias("max_step_deg"),
        F.max("velocity_deg_s").alias("max_velocity_deg_s"),
        F.max("acceleration_deg_s2").alias("max_acceleration_deg_s2"),
        F.count_if("jump").alias("jump_edge_count"),
        F.count_if("acceleration_over").alias("acceleration_over_count"),
        F.count_if("spike").alias("single_frame_spike_count"),
    )


def audit_gaps(
    stream: Track, time: str, index: str, floor_ms: Column, config: TimestampQuality | None = None
) -> DataFrame:
    """Clock part of the audit: median step, gap limits with a floor, counts."""
    config = config or TimestampQuality()
    looked = carry(stream, prev={"_t1": F.col(time)}).df.withColumn("_floor", floor_ms)
    dt = looked.withColumn("dt_ms", (F.col(time) - F.col("_t1")) / F.lit(1e9) * 1000)
    first = summarise(
        dt,
        stream.keys,
        [
            F.count("*").alias("samples"),
            F.min("dt_ms").alias("min_dt_ms"),
            F.max("dt_ms").alias("max_dt_ms"),
            F.count_if(F.col("dt_ms") <= 0).alias("nonpositive_count"),
            F.count_if(F.col("dt_ms") <= config.duplicate_epsilon_ms).alias("near_duplicate_count"),
            F.first("_floor").alias("_floor"),
        ],
        {"dt": (F.col("dt_ms"), {"median_dt_ms": 0.5, "p95_dt_ms": 0.95})},
        largest=stream.largest,
    )
    limits = first.withColumns(
        {
            "gap_warning_ms": F.greatest(F.col("_floor"), F.col("median_dt_ms") * config.gap_warning_factor),
            "gap_fail_ms": F.greatest(F.col("_floor"), F.col("median_dt_ms") * config.gap_fail_factor),
        }
    ).drop("_floor")
    held = [F.first(c).alias(c) for c in limits.columns if c not in stream.keys]
    return dt.select(*stream.keys, "dt_ms").join(limits, list(stream.keys)).groupBy(*stream.keys).agg(
        *held,
        F.count_if(F.col("dt_ms") > F.col("gap_warning_ms")).alias("gap_count"),
        F.count_if(F.col("dt_ms") > F.col("gap_fail_ms")).alias("severe_gap_count"),
    )


def audit_summary(flagged: DataFrame, clock: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals and status per stream from the cells and the clock audit."""
    totals = flagged.groupBy(*keys).agg(
        F.max("step_deg").alias("max_step_deg"),
        F.max("velocity_deg_s").alias("max_velocity_deg_s"),
        F.max("acceleration_deg_s2").alias("max_acceleration_deg_s2"),
        *[
            F.count_if(flag).alias(f"{flag}_count")
            for flag in ("jump", "step_over", "velocity_over", "velocity_near", "acceleration_over", "acceleration_near", "spike")
        ],
    )
    joined = totals.join(clock.select(*keys, "nonpositive_count", "near_duplicate_count", "gap_count", "severe_gap_count"), list(keys))
    review = (
        (F.col("jump_count") > 0)
        | (F.col("acceleration_over_count") > 0)
        | (F.col("spike_count") > 0)
        | (F.col("near_duplicate_count") > 0)
        | (F.col("severe_gap_count") > 0)
    )
    warning = (F.col("velocity_near_count") > 0) | (F.col("acceleration_near_count") > 0) | (F.col("gap_count") > 0)
    status = (
        F.when(F.col("nonpositive_count") > 0, "invalid")
        .when(review, "review")
        .when(warning, "warning")
        .otherwise("clean_under_checked_thresholds")
    )
    return joined.withColumn("status", status)


def largest_step(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The largest step; the earliest frame, then the lowest joint, wins a tie."""
    picked = F.struct("frame", "joint", "previous", "value", "signed_step_deg", "step_deg")
    best = cells.filter(F.col("step_deg").isNotNull()).groupBy(*keys).agg(
        F.max_by(picked, F.struct("step_deg", -F.col("frame"), -F.col("joint"))).alias("_b")
    )
    return best.select(
        *keys,
        F.col("_b.joint").alias("joint"),
        (F.col("_b.frame") - 1).alias("from_frame"),
        F.col("_b.frame").alias("to_frame"),
        F.col("_b.previous").alias("from_value"),
        F.col("_b.value").alias("to_value"),
        F.col("_b.signed_step_deg").alias("signed_step_deg"),
    )
