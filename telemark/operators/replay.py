"""Data part of trajectory replay: selection, limits, upsampling, error figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark import contract
from telemark.functions.scalar import is_finite
from telemark.functions.sequence import Track, carry


def select_frames(
    frames: DataFrame, frame: str, *, start: int = 0, end: int | None = None, stride: int = 1, max_frames: int | None = None
) -> DataFrame:
    """Every ``stride``-th frame of a range, at most ``max_frames`` of them."""
    if start < 0 or stride < 1 or (max_frames is not None and max_frames < 1):
        raise ValueError("start, stride and max_frames must be positive")
    at = F.col(frame)
    chosen = (at >= start) & ((at - start) % stride == 0)
    if end is not None:
        chosen &= at < end
    if max_frames is not None:
        chosen &= at < start + stride * max_frames
    return frames.filter(chosen)


def arm_columns(names: Sequence[str]) -> list[int]:
    """Positions of the arm joints in a dataset's feature names, in arm order."""
    where: dict[str, int] = {}
    for column, name in enumerate(names):
        key = name.lower().replace("_joint", "_j")
        if key in contract.FOLLOWER_JOINT_NAMES:
            if key in where:
                raise ValueError(f"two columns describe joint {name}")
            where[key] = column
    missing = [name for name in contract.FOLLOWER_JOINT_NAMES if name not in where]
    if missing:
        raise ValueError(f"missing arm joints: {missing}")
    return [where[name] for name in contract.FOLLOWER_JOINT_NAMES]


def arm_trajectory(frames: DataFrame, values: str, names: Sequence[str], time: str) -> DataFrame:
    """``targets`` in arm order; a non-finite value stops the job."""
    picked = F.array(*[F.get(F.col(values), F.lit(i)) for i in arm_columns(names)]).cast("array<double>")
    sound = F.forall(picked, is_finite) & is_finite(F.col(time))
    checked = F.when(sound, picked).otherwise(F.raise_error(F.lit("non-finite trajectory")).cast("array<double>"))
    return frames.withColumn("targets", checked)


def limit_violations(frames: DataFrame, keys: Sequence[str], frame: str, targets: str, lower: Column, upper: Column) -> DataFrame:
    """Targets outside the joint range, counted per joint."""
    cells = frames.select(*keys, F.posexplode(targets).alias("joint", "_x"))
    excess = F.greatest(lower - F.col("_x"), F.col("_x") - upper)
    return (
        cells.withColumn("_e", excess)
        .filter(F.col("_e") > 1e-6)
        .groupBy(*keys, "joint")
        .agg(F.count("*").alias("violations"), F.max(F.degrees("_e")).alias("max_violation_deg"))
    )


def clamp(targets: str, lower: Column, upper: Column) -> Column:
    return F.transform(targets, lambda x: F.greatest(lower, F.least(upper, x)))


def upsample(
    frames: Track,
    targets: str,
    frame: str,
    time: str,
    *,
    step_s: float,
    speed: float = 1.0,
    mode: str = "linear",
    fallback_dt_s: float = 0.05,
) -> DataFrame:
    """Controller targets between neighbouring frames, by line or by holding."""
    if mode not in ("linear", "hold"):
        raise ValueError("mode is linear or hold")
    looked = carry(frames, next={"_next": F.col(targets), "_tn": F.col(time)}).df.filter(F.col("_next").isNotNull())
    dt = F.col("_tn") - F.col(time)
    dt = F.when(dt > 0, dt).otherwise(F.lit(fallback_dt_s))
    steps = F.greatest(F.lit(1), F.rint(dt / speed / step_s).cast("int"))
    rows = looked.withColumn("_steps", steps).withColumn("substep", F.explode(F.sequence(F.lit(1), F.col("_steps"))))
    share = F.col("substep") / F.col("_steps")
    moved = F.zip_with(targets, "_next", lambda a, b: a + share * (b - a))
    return rows.select(*frames.keys, frame, "substep", (moved if mode == "linear" else F.col(targets)).alias("target"))


def trajectory_summary(frames: Track, values: str, frame: str, time: str, joints: int = contract.ARM_JOINTS) -> DataFrame:
    looked = carry(frames, prev={"_v1": F.col(values)}).df
    step = F.array_max(F.zip_with(F.slice(values, 1, joints), F.slice("_v1", 1, joints), lambda a, b: F.abs(a - b)))
    return looked.groupBy(*frames.keys).agg(
        F.count("*").alias("frames"),
        (F.max(time) - F.min(time)).alias("duration_s"),
        F.coalesce(F.degrees(F.max(step)), F.lit(0.0)).alias("max_step_deg"),
    )


def final_error(frames: DataFrame, keys: Sequence[str], target: str, reached: str, joints: int = contract.ARM_JOINTS) -> DataFrame:
    """Root mean square and largest joint error, in degrees."""
    gap = F.zip_with(F.slice(target, 1, joints), F.slice(reached, 1, joints), lambda a, b: a.cast("double") - b.cast("double"))
    cells = frames.select(*keys, F.explode(gap).alias("_e"))
    return cells.groupBy(*keys).agg(
        F.degrees(F.sqrt(F.avg(F.col("_e") * F.col("_e")))).alias("rmse_deg"),
        F.degrees(F.max(F.abs("_e"))).alias("max_error_deg"),
    )
