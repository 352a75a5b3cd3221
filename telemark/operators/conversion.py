"""From aligned streams to training frames: gates, vectors, episode plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark import contract
from telemark.config import Conversion
from telemark.functions.quantile import summarise
from telemark.functions.scalar import clip, is_finite, named_values, to_ms
from telemark.functions.sequence import Track, carry, track
from telemark.operators.align import align_to_grid, rounded_grid, trimmed_spans
from telemark.operators.repair import affine_repair
from telemark.sources.episodes import missing_topics

GROUPS = {
    "state": (contract.FOLLOWER_JOINTS, contract.LEFT_GRIPPER_STATE, contract.RIGHT_GRIPPER_STATE),
    "action": (contract.LEADER_JOINTS, contract.LEFT_GRIPPER_COMMAND, contract.RIGHT_GRIPPER_COMMAND),
    **{feature: (topic,) for feature, topic in contract.IMAGE_FEATURES.items()},
}


def gripper_range(rows: DataFrame, keys: Sequence[str], value: str, scale: float) -> DataFrame:
    """Range per topic and whether it leaves [0, scale] by more than a thousandth."""
    if scale <= 0:
        raise ValueError("the gripper scale must be positive")
    slack = scale * 1e-3
    seen = rows.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return seen.withColumn("outside", (F.col("low") < -slack) | (F.col("high") > scale + slack))


def combined_residuals(mappings: DataFrame, episode: Sequence[str], groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per target and group of streams: the largest absolute residual."""
    name = F.lit(None).cast("string")
    for group, topics in groups.items():
        name = F.when(F.col("topic").isin(*topics), group).otherwise(name)
    rows = mappings.withColumn("stream_group", name).filter(F.col("stream_group").isNotNull())
    return rows.groupBy(*episode, "stream_group", "target_index").agg(
        F.max(F.abs(to_ms(F.col("residual_ns")))).alias("abs_ms")
    )


def residual_report(combined: DataFrame, keys: Sequence[str], *, bound: int | None = None) -> DataFrame:
    return summarise(
        combined,
        keys,
        [F.max("abs_ms").alias("max_abs_ms")],
        {"r": (F.col("abs_ms"), {"median_abs_ms": 0.5, "p95_abs_ms": 0.95})},
        bound=bound,
    )


def residual_gate(combined: DataFrame, episode: Sequence[str], limits_ms: Mapping[str, float]) -> DataFrame:
    """Groups whose worst residual is over their limit: these episodes are rejected."""
    worst = combined.groupBy(*episode, "stream_group").agg(F.max("abs_ms").alias("max_abs_ms"))
    limit = F.lit(float("inf"))
    for group, value in limits_ms.items():
        limit = F.when(F.col("stream_group") == group, F.lit(float(value))).otherwise(limit)
    return worst.filter(F.col("max_abs_ms") > limit)


def side_by_side(rows: DataFrame, episode: Sequence[str], topics: Mapping[str, str], value: str) -> DataFrame:
    """One row per target with the value of every named stream (one shuffle, no joins)."""
    picks = [F.max_by(value, F.when(F.col("topic") == topic, F.lit(1))).alias(name) for name, topic in topics.items()]
    return rows.groupBy(*episode, "target_index").agg(*picks)


@dataclass(frozen=True)
class EpisodePlan:
    """Lazy results of planning a conversion; nothing is written yet."""

    frames: DataFrame
    mappings: DataFrame
    residuals: DataFrame
    rejected: DataFrame
    spans: DataFrame


def converter_time() -> Column:
    """Joints and images use the header stamp, grippers the log time."""
    gripper = F.col("topic").isin(*[t for t in contract.REQUIRED_TOPICS if "/gripper/" in t])
    return F.when(gripper, F.col("log_time_ns")).otherwise(F.col("header_time_ns"))


def plan_episodes(
    messages: DataFrame,
    annotations: DataFrame | None = None,
    config: Conversion | None = None,
    *,
    bound: int | None = None,
) -> EpisodePlan:
    """Align the nine training streams of every episode and assemble its frames.

    Episodes that miss a topic or a joint, leave the gripper range, have no
    common time or exceed a residual limit end up in ``rejected`` with a reason;
    the others are not affected.
    """
    config = config or Conversion()
    if annotations is not None:  # an excluded episode is not looked at, so its faults stop nothing
        excluded = annotations.filter(~F.coalesce("include", F.lit(True))).select("episode")
        messages = messages.join(excluded, "episode", "left_anti")
    wanted = messages.filter(F.col("topic").isin(*contract.REQUIRED_TOPICS)).withColumn("time_ns", converter_time())
    joints = F.when(
        F.col("topic") == contract.FOLLOWER_JOINTS, named_values(contract.FOLLOWER_JOINT_NAMES)
    ).when(F.col("topic") == contract.LEADER_JOINTS, named_values(contract.LEADER_JOINT_NAMES))
    grip = F.when(F.col("topic").contains("/gripper/"), F.col("values"))
    wanted = wanted.withColumn("vector", F.coalesce(joints, grip))
    rejections = [_reason(missing_topics(wanted, ["episode"], contract.REQUIRED_TOPICS), "missing required topic")]
    numeric = ~F.col("topic").isin(*contract.IMAGE_TOPICS)
    unusable = wanted.filter(
        numeric & (F.col("vector").isNull() | F.exists("vector", lambda x: ~is_finite(x)))
    )
    rejections.append(_reason(unusable, "missing joint or non-finite value"))
    grips = wanted.filter(F.col("topic").contains("/gripper/")).withColumn("_g", F.get("vector", F.lit(0)))
    outside = gripper_range(grips, ["episode", "topic"], "_g", config.gripper_scale).filter("outside")
    rejections.append(_reason(outside, "gripper outside its range"))

    line = track(wanted, ["episode", "topic"], ["time_ns", "record_index"], bound=bound)
    line = carry(line, number="sorted_index")
    repaired = affine_repair(line, "sorted_index", "time_ns")
    used = F.when(F.col("topic").isin(*contract.IMAGE_TOPICS), F.col("repaired_ns")).otherwise(F.col("time_ns"))
    timed = repaired.withColumn("used_ns", used)
    ready = track(timed, ["episode", "topic"], ["used_ns", "record_index"], bound=line.largest)

    per_topic = ready.df.groupBy("episode", "topic").agg(F.min("used_ns").alias("_f"), F.max("used_ns").alias("_l"))
    spans = per_topic.groupBy("episode").agg(
        F.min("_f").alias("origin_ns"), F.max("_f").alias("start_ns"), F.min("_l").alias("end_ns")
    )
    if annotations is None:
        start_s, end_s = F.lit(0.0), F.lit(None).cast("double")
    else:
        spans = spans.join(annotations.select("episode", "include", "start_time_s", "end_time_s"), "episode", "left")
        spans = spans.filter(F.coalesce("include", F.lit(True)))
        start_s, end_s = F.col("start_time_s"), F.col("end_time_s")
    trimmed = trimmed_spans(spans, start_s, end_s)
    rejections.append(_reason(trimmed.filter(F.col("end_ns") <= F.col("start_ns")), "empty time range"))
    grid = rounded_grid(trimmed, config.fps)
    mappings = align_to_grid(
        ready,
        grid,
        ["episode"],
        "used_ns",
        {"record_index": F.col("record_index"), "vector": F.col("vector"), "image": F.col("image")},
        fractional=True,
    )
    combined = combined_residuals(mappings, ["episode"], GROUPS)
    limits = {
        "state": config.max_state_delta_ms,
        "action": config.max_action_delta_ms,
        **dict.fromkeys(contract.IMAGE_FEATURES, config.max_image_delta_ms),
    }
    rejections.append(_reason(residual_gate(combined, ["episode"], limits), "residual over its limit"))
    rejected = rejections[0]
    for more in rejections[1:]:
        rejected = rejected.unionByName(more)
    # A union under AQE may coalesce otherwise than the side it is joined with, so it gets a shuffle of its own.
    rejected = rejected.repartition("episode", "reason")
    frames = training_frames(mappings, config)
    frames = frames.join(rejected.select("episode").distinct(), "episode", "left_anti")
    return EpisodePlan(frames, mappings, residual_report(combined, ["episode", "stream_group"], bound=bound), rejected, grid)


def _reason(rows: DataFrame, text: str) -> DataFrame:
    return rows.select("episode", F.lit(text).alias("reason")).distinct()


def training_frames(mappings: DataFrame, config: Conversion) -> DataFrame:
    """State and action of sixteen single-precision values, and the image pointers."""
    vectors = {
        "_state": contract.FOLLOWER_JOINTS,
        "_state_left": contract.LEFT_GRIPPER_STATE,
        "_state_right": contract.RIGHT_GRIPPER_STATE,
        "_action": contract.LEADER_JOINTS,
        "_action_left": contract.LEFT_GRIPPER_COMMAND,
        "_action_right": contract.RIGHT_GRIPPER_COMMAND,
    }
    here = {topic: F.when(F.col("topic") == topic, F.lit(1)) for topic in contract.REQUIRED_TOPICS}
    picks = [F.max_by("vector", here[topic]).alias(name) for name, topic in vectors.items()]
    shots = [F.max_by("image", here[topic]).alias(feature) for feature, topic in contract.IMAGE_FEATURES.items()]
    rows = mappings.groupBy("episode", "target_index").agg(*picks, *shots)

    def joined(name: str) -> Column:
        arm = F.transform(name, lambda x: F.radians(x))
        sides = [clip(F.get(f"{name}_{side}", F.lit(0)) / config.gripper_scale, 0.0, 1.0) for side in ("left", "right")]
        return F.concat(arm, F.array(*sides)).cast("array<float>")

    return rows.select(
        "episode",
        F.col("target_index").alias("frame_index"),
        (F.col("target_index") / F.lit(float(config.fps))).alias("timestamp"),
        joined("_state").alias("observation.state"),
        joined("_action").alias("action"),
        *[F.col(f"`{feature}`") for feature in contract.IMAGE_FEATURES],
    )
