"""Value metrics, tracking, risk rules and their roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark import contract
from telemark.functions.quantile import summarise
from telemark.functions.scalar import is_finite, is_infinite
from telemark.functions.sequence import Track, carry, track
from telemark.operators.timeline import top_rows


def array_metrics(rows: DataFrame, keys: Sequence[str], values: str) -> DataFrame:
    """Per dimension: NaN and infinity counts, finite share, range, mean, spread.

    NaN is skipped in the statistics; infinities take part, as in the contract.
    """
    cells = rows.select(*keys, F.posexplode(values).alias("dimension", "_x"))
    x = F.when(~F.isnan("_x"), F.col("_x"))
    metrics = cells.groupBy(*keys, "dimension").agg(
        F.count("*").alias("cells"),
        F.count_if(F.isnan("_x")).alias("nan_count"),
        F.count_if(is_infinite(F.col("_x")) & ~F.isnan("_x")).alias("inf_count"),
        (F.count_if(is_finite(F.col("_x"))) / F.count("*")).alias("finite_ratio"),
        F.min(x).alias("min_value"),
        F.max(x).alias("max_value"),
        F.avg(x).alias("mean_value"),
        F.stddev_pop(x).alias("std_value"),
    )
    return metrics.withColumn("constant", F.coalesce(F.col("std_value") < 1e-8, F.lit(False)))


def tracking_cells(rows: DataFrame, keys: Sequence[str], state: str, action: str, joints: int = contract.ARM_JOINTS) -> DataFrame:
    """Absolute leader-follower error in degrees, one row per frame and joint."""
    gap = F.zip_with(F.slice(action, 1, joints), F.slice(state, 1, joints), lambda a, s: F.degrees(F.abs(a - s)))
    return rows.select(*keys, F.posexplode(gap).alias("joint", "error_deg"))


def tracking_error(cells: DataFrame, keys: Sequence[str], *, bound: int | None = None) -> DataFrame:
    return summarise(
        cells,
        [*keys, "joint"],
        [F.max("error_deg").alias("max_abs_deg")],
        {"e": (F.col("error_deg"), {"median_abs_deg": 0.5, "p95_abs_deg": 0.95})},
        bound=bound,
    )


def tracking_totals(cells: DataFrame, keys: Sequence[str], *, bound: int | None = None) -> DataFrame:
    """Error over all joints, and the worst joint."""
    overall = summarise(cells, keys, [F.max("error_deg").alias("max_abs_deg")], {"e": (F.col("error_deg"), {"global_p95_abs_deg": 0.95})}, bound=bound)
    joints = tracking_error(cells, keys, bound=bound)
    worst = joints.groupBy(*keys).agg(F.max("p95_abs_deg").alias("worst_joint_p95_deg"))
    return overall.join(worst, list(keys))


def action_steps(frames: Track, action: str, frame: str, joints: int = contract.ARM_JOINTS) -> DataFrame:
    """Largest joint step of every frame after the first, in degrees.

    Converted vectors are single precision, and so is the difference.
    """
    return steps_between(carry(frames, prev={"_a1": F.col(action)}).df, frames.keys, action, frame, joints)


def steps_between(looked: DataFrame, keys: Sequence[str], action: str, frame: str, joints: int) -> DataFrame:
    """The steps of frames that know the vector before theirs as ``_a1``."""
    looked = looked.filter(F.col("_a1").isNotNull())
    step = F.zip_with(F.slice(action, 1, joints), F.slice("_a1", 1, joints), lambda a, b: F.abs(a - b))
    return looked.select(*keys, F.col(frame).alias("output_frame"), F.degrees(F.array_max(step)).alias("max_joint_step_deg"))


def action_quality(steps: DataFrame, keys: Sequence[str], limit_deg: float) -> DataFrame:
    return steps.groupBy(*keys).agg(
        F.max("max_joint_step_deg").alias("max_arm_action_step_deg"),
        F.count_if(F.col("max_joint_step_deg") > limit_deg).alias("jump_count"),
    )


def largest_jumps(steps: DataFrame, keys: Sequence[str], limit: int = 10) -> DataFrame:
    return top_rows(steps, keys, [F.col("max_joint_step_deg").desc(), F.col("output_frame").desc()], limit)


def vector_ranges(rows: DataFrame, keys: Sequence[str], vectors: Sequence[str]) -> DataFrame:
    """Minimum and maximum of every dimension of the named vectors."""
    parts = None
    for name in vectors:
        cells = rows.select(*keys, F.lit(name).alias("vector"), F.posexplode(name).alias("dimension", "_x"))
        parts = cells if parts is None else parts.unionByName(cells)
    return parts.groupBy(*keys, "vector", "dimension").agg(F.min("_x").alias("min_value"), F.max("_x").alias("max_value"))


def tcp_scale(rows: DataFrame, keys: Sequence[str], measured: Column, leader: Column, *, bound: int | None = None) -> DataFrame:
    """Ratio of the typical translation of two tool positions given as vectors."""
    cells = rows.select(*keys, F.explode(F.arrays_zip(F.slice(measured, 1, 3).alias("m"), F.slice(leader, 1, 3).alias("l"))).alias("_t"))
    medians = summarise(
        cells,
        keys,
        [],
        {
            "m": (F.abs("_t.m"), {"measured_translation_median_abs": 0.5}),
            "l": (F.abs("_t.l"), {"lead_translation_median_abs": 0.5}),
        },
        bound=bound,
    )
    ratio = F.col("measured_translation_median_abs") / F.greatest(F.col("lead_translation_median_abs"), F.lit(1e-12))
    return medians.withColumn("translation_scale_ratio", ratio)


def tcp_streams(messages: DataFrame, time: str = "time_ns") -> DataFrame:
    """The same comparison for the two left tool streams of recordings, per episode.

    Episodes that lack one of the streams are left out.
    """
    measured, leader = contract.LEFT_TCP_STATE, contract.LEFT_LEADER_TCP
    rows = messages.filter(F.col("topic").isin(measured, leader) & F.col("values").isNotNull())
    cells = rows.select("episode", "topic", F.explode(F.slice("values", 1, 3)).alias("_x"))
    medians = summarise(cells, ["episode", "topic"], [], {"x": (F.abs("_x"), {"_m": 0.5})})
    both = medians.groupBy("episode").agg(
        F.max(F.when(F.col("topic") == measured, F.col("_m"))).alias("measured_translation_median_abs"),
        F.max(F.when(F.col("topic") == leader, F.col("_m"))).alias("lead_translation_median_abs"),
    )
    ratio = F.col("measured_translation_median_abs") / F.greatest(F.col("lead_translation_median_abs"), F.lit(1e-12))
    line = track(rows.filter(F.col("topic") == leader), ["episode"], [time, "record_index"])
    return both.withColumn("translation_scale_ratio", ratio).dropna().join(orientation_step(line, "values"), "episode")


def orientation_step(frames: Track, vector: str) -> DataFrame:
    """Largest single-step change of the three orientation components."""
    looked = carry(frames, prev={"_v1": F.col(vector)}).df
    change = F.array_max(F.zip_with(F.slice(vector, 4, 3), F.slice("_v1", 4, 3), lambda a, b: F.abs(a - b)))
    return looked.groupBy(*frames.keys).agg(F.coalesce(F.max(change), F.lit(0.0)).alias("lead_orientation_max_step"))


# --- risk rules -----------------------------------------------------------

def risk(risk_id: str, status, severity, evidence: Column, when: Column | None = None) -> Column:
    """A risk row as a struct, or null where it does not apply."""
    row = F.struct(
        F.lit(risk_id).alias("risk_id"),
        (F.lit(status) if isinstance(status, str) else status).alias("status"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        evidence.cast("string").alias("evidence"),
    )
    return row if when is None else F.when(when, row)


def apply_rules(metrics: DataFrame, keys: Sequence[str], rules: Sequence[Column], subject: Column) -> DataFrame:
    """Evaluate rules on rows of metrics: all rules in one pass, one output row per hit."""
    hits = F.array_compact(F.array(*rules))
    return metrics.select(*keys, subject.cast("string").alias("subject"), F.explode(hits).alias("_r")).select(
        *keys, "subject", "_r.*"
    )


def pass_or(bad: Column, status: str) -> Column:
    return F.when(bad, status).otherwise("pass")


def numeric_rules(gap_limit_ms: Column) -> list[Column]:
    """For one numeric topic per row."""
    unusable = F.col("nan_count") + F.col("inf_count")
    return [
        risk("numeric_non_finite", "fail", "high", unusable, unusable > 0),
        risk("numeric_timestamp_nonpositive", "fail", "high", F.col("nonpositive"), F.col("nonpositive") > 0),
        risk("numeric_timestamp_gap", "warning", "medium", F.col("dt_max"), F.col("dt_max") > gap_limit_ms),
    ]


def camera_rules(max_gap_ms: float, is_head: Column) -> list[Column]:
    """For one camera per row."""
    severity = F.when(is_head, "high").otherwise("medium")
    return [
        risk("camera_timestamp_nonpositive", "warning", severity, F.col("nonpositive"), F.col("nonpositive") > 0),
        risk("camera_timestamp_gap", "warning", "medium", F.col("dt_max"), F.col("dt_max") > max_gap_ms),
        risk("image_decode_failure", "fail", "high", F.col("decode_failures"), F.col("decode_failures") > 0),
        risk("image_shape_changed", "fail", "high", F.col("shapes"), F.col("shapes") > 1),
    ]


def residual_rule(risk_id: str, limit_ms: float) -> Column:
    value = F.col("max_abs_ms")
    return risk(risk_id, pass_or(~(value <= limit_ms), "fail"), "high", value)


def motion_rules(max_tracking_p95_deg: float) -> list[Column]:
    worst = F.col("worst_joint_p95_deg")
    return [
        risk("action_discontinuity", pass_or(F.col("jump_count") > 0, "warning"), "high", F.col("jump_count")),
        risk("leader_follower_tracking", pass_or(~(worst <= max_tracking_p95_deg), "warning"), "medium", worst),
    ]


def label_rules() -> list[Column]:
    success = F.col("success")
    no_task = F.coalesce(F.col("task"), F.lit("")).isin("", "__TASK_NOT_SET__")
    nothing = F.lit(None)
    return [
        risk("task_label_missing", "fail", "high", nothing, no_task),
        risk("success_label_unverified", "warning", "medium", nothing, success.isNull()),
        risk("demonstration_failed", "fail", "high", nothing, ~success),
        risk("success_label_verified", "pass", "medium", nothing, success),
    ]


def tcp_rule() -> Column:
    scale, wrap = F.col("translation_scale_ratio"), F.col("lead_orientation_max_step")
    return risk("tcp_unit_and_wrap", "warning", "high", scale, (scale > 100) | (wrap > 180))


def failure_rule(error: Column) -> Column:
    return risk("analysis_failed", "fail", "high", error)


def roll_up(risks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """High failures and warnings per key, and the verdict."""
    counted = risks.groupBy(*keys).agg(
        F.count_if((F.col("status") == "fail") & (F.col("severity") == "high")).alias("high_failures"),
        F.count_if(F.col("status") == "warning").alias("warnings"),
        F.count("*").alias("items"),
    )
    verdict = F.when(F.col("high_failures") > 0, "fail").when(F.col("warnings") > 0, "warning").otherwise("pass")
    return counted.withColumn("overall_status", verdict)


def run_status(episodes: DataFrame) -> DataFrame:
    """Episodes per verdict and the verdict of the whole run."""
    counted = episodes.agg(
        *[F.count_if(F.col("overall_status") == s).alias(f"{s}_episodes") for s in ("fail", "warning", "pass")]
    )
    verdict = F.when(F.col("fail_episodes") > 0, "fail").when(F.col("warning_episodes") > 0, "warning").otherwise("pass")
    return counted.withColumn("overall_status", verdict)


def annotated(episodes: DataFrame, overrides: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Episode settings: the override where given, else the default."""
    joined = episodes.join(overrides, "episode", "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items() if value is not None}
    )
