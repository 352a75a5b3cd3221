"""Joint jumps: conservative repair of short spikes, merged events, windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark.config import SpikeRepair
from telemark.functions.sequence import Track, carry, islands, track
from telemark.operators.timeline import top_rows


def joint_edges(frames: Track, values: str, frame: str, seconds: Column, config: SpikeRepair, *, joints: Sequence[int] | None = None) -> DataFrame:
    """Abnormal steps only: one row per joint whose step or speed is over the limit.

    ``edge`` is the frame the step starts from.  ``seconds`` is the time of a frame.
    """
    looked = carry(frames.derive({"_s": seconds}), prev={"_v1": F.col(values), "_s1": F.col("_s")}).df
    dt = F.col("_s") - F.col("_s1")
    cells = looked.filter(F.col("_v1").isNotNull()).select(
        *frames.keys,
        (F.col(frame) - 1).alias("edge"),
        F.col("_s1").alias("from_s"),
        F.col("_s").alias("to_s"),
        dt.alias("_dt"),
        F.posexplode(F.arrays_zip(F.col("_v1").alias("a"), F.col(values).alias("b"))).alias("joint", "_j"),
    )
    if joints is not None:
        cells = cells.filter(F.col("joint").isin(*joints))
    step = F.col("_j.b") - F.col("_j.a")
    cells = cells.select(
        *frames.keys,
        "joint",
        "edge",
        "from_s",
        "to_s",
        F.col("_j.a").alias("from_value"),
        F.col("_j.b").alias("to_value"),
        F.abs(step).alias("step"),
        F.abs(step / F.nullif(F.col("_dt"), F.lit(0.0))).alias("velocity"),
    )
    return cells.filter((F.col("step") > config.max_step_deg) | (F.col("velocity") > config.max_velocity_deg_s))


def spike_runs(
    edges: DataFrame, extent: DataFrame, keys: Sequence[str], config: SpikeRepair, *, bound: int | None = None
) -> DataFrame:
    """Judge each run of abnormal steps of one joint: repair it or leave it for review.

    ``extent`` gives per key the number of ``frames`` and the first time ``origin_s``.
    """
    keys = list(keys)
    per_joint = [*keys, "joint"]
    numbered = islands(track(edges, per_joint, ["edge"], bound=bound), F.lit(True), "edge").rows()
    runs = numbered.groupBy(*per_joint, "island").agg(
        F.min("edge").alias("start_frame"),
        (F.max("edge") + 1).alias("end_frame"),
        F.min("from_s").alias("_from"),
        F.max("to_s").alias("_to"),
        F.max("step").alias("max_step_deg"),
        F.max("velocity").alias("max_velocity_deg_s"),
        F.min_by("from_value", "edge").alias("left_value"),
        F.max_by("to_value", "edge").alias("right_value"),
    )
    runs = runs.join(extent, keys).withColumn("interior", F.col("end_frame") - F.col("start_frame") - 1)
    edge_case = (F.col("start_frame") == 0) | (F.col("end_frame") >= F.col("frames") - 1)
    early = (
        F.when(edge_case, "boundary_event")
        .when(F.col("interior") == 0, "persistent_step")
        .when(F.col("interior") > config.max_repair_run_frames, "run_too_long")
    )
    runs = runs.withColumn("_early", early)
    open_runs = runs.filter(F.col("_early").isNull()).select(
        *per_joint, "island", "start_frame", "end_frame", "left_value", "right_value", "interior"
    )
    inner = numbered.select(*per_joint, "island", "edge", "to_value").join(open_runs, [*per_joint, "island"])
    inner = inner.filter(F.col("edge") + 1 < F.col("end_frame"))
    line = interpolated(F.col("left_value"), F.col("right_value"), F.col("edge") + 1 - F.col("start_frame"), F.col("interior") + 1)
    residual = inner.groupBy(*per_joint, "island").agg(F.max(F.abs(F.col("to_value") - line)).alias("_residual"))
    judged = runs.join(residual, [*per_joint, "island"], "left")
    late = F.when(F.abs(F.col("right_value") - F.col("left_value")) > config.max_anchor_delta_deg, "persistent_step").when(
        F.col("_residual") < config.min_correction_deg, "small_interpolation_residual"
    )
    reason = F.coalesce(F.col("_early"), late)
    return judged.select(
        *per_joint,
        "start_frame",
        "end_frame",
        (F.col("_from") - F.col("origin_s")).alias("start_time_s"),
        (F.col("_to") - F.col("origin_s")).alias("end_time_s"),
        "max_step_deg",
        "max_velocity_deg_s",
        F.coalesce("_residual", F.lit(0.0)).alias("max_interpolation_residual_deg"),
        F.when(reason.isNull(), "linear_interpolation").otherwise("manual_review").alias("method"),
        reason.alias("reason"),
        "left_value",
        "right_value",
    )


def interpolated(left: Column, right: Column, step: Column, steps: Column) -> Column:
    return left + step * ((right - left) / steps)


def repaired_cells(runs: DataFrame, keys: Sequence[str], config: SpikeRepair) -> DataFrame:
    """New values of the frames inside repaired runs; a run has at most a few."""
    fixed = runs.filter(F.col("method") == "linear_interpolation")
    inside = fixed.withColumn("frame", F.explode(F.sequence(F.col("start_frame") + 1, F.col("end_frame") - 1)))
    value = interpolated(
        F.col("left_value"),
        F.col("right_value"),
        F.col("frame") - F.col("start_frame"),
        F.col("end_frame") - F.col("start_frame"),
    )
    return inside.select(*keys, "joint", "frame", value.alias("corrected"))


def corrected_frames(frames: DataFrame, cells: DataFrame, keys: Sequence[str], values: str, frame: str) -> DataFrame:
    """Frames with the repaired joints written into their vectors."""
    per_frame = cells.groupBy(*keys, F.col("frame").alias(frame)).agg(
        F.map_from_entries(F.collect_list(F.struct("joint", "corrected"))).alias("_fix")
    )
    joined = frames.join(per_frame, [*keys, frame], "left")
    patched = F.transform(F.col(values), lambda v, i: F.coalesce(F.try_element_at(F.col("_fix"), i), v))
    return joined.withColumn(values, F.when(F.col("_fix").isNull(), F.col(values)).otherwise(patched)).drop("_fix")


def spike_status(runs: DataFrame, cells_changed: DataFrame, extent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """review > repaired > clean, per episode."""
    keys = list(keys)
    counted = runs.groupBy(*keys).agg(
        F.count_if(F.col("method") == "linear_interpolation").alias("repair_event_count"),
        F.count_if(F.col("method") == "manual_review").alias("review_event_count"),
    )
    changed = cells_changed.groupBy(*keys).agg(F.count("*").alias("changed_value_count"))
    joined = extent.select(*keys).join(counted, keys, "left").join(changed, keys, "left").fillna(0)
    status = F.when(F.col("review_event_count") > 0, "review").when(F.col("changed_value_count") > 0, "repaired")
    return joined.withColumn("status", status.otherwise("clean"))


def status_summary(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(
        F.count("*").alias("episodes"),
        F.sum("repair_event_count").alias("repair_events"),
        F.sum("review_event_count").alias("review_events"),
    )


def merged_jumps(edges: DataFrame, keys: Sequence[str], *, bound: int | None = None) -> DataFrame:
    """Abnormal intervals merged over all joints of an episode."""
    per_frame = edges.groupBy(*keys, "edge").agg(
        F.first("from_s").alias("from_s"),
        F.first("to_s").alias("to_s"),
        F.max("step").alias("step"),
        F.max("velocity").alias("velocity"),
        F.collect_set("joint").alias("joints"),
    )
    numbered = islands(track(per_frame, keys, ["edge"], bound=bound), F.lit(True), "edge").rows()
    unfolded = numbered.select(*keys, "island", "edge", "from_s", "to_s", "step", "velocity", F.explode("joints").alias("joint"))
    # The set is bounded by the number of joints of the robot.
    return unfolded.groupBy(*keys, "island").agg(
        F.min("edge").alias("edge_start"),
        F.max("edge").alias("edge_end"),
        F.min("edge").alias("sample_start"),
        (F.max("edge") + 1).alias("sample_end"),
        F.min("from_s").alias("start_time_s"),
        F.max("to_s").alias("end_time_s"),
        F.max("step").alias("max_step_deg"),
        F.max("velocity").alias("max_velocity_deg_s"),
        F.array_sort(F.collect_set("joint")).alias("joints"),
    ).drop("island")


def strongest_jump(jumps: DataFrame, keys: Sequence[str]) -> DataFrame:
    order = [F.col("max_step_deg").desc(), F.col("max_velocity_deg_s").desc(), F.col("edge_start")]
    return top_rows(jumps, keys, order, 1).drop("place")


def abnormal_window(frames: DataFrame, events: DataFrame, extent: DataFrame, keys: Sequence[str], frame: str, seconds: Column, width_s: float) -> DataFrame:
    """Frames shown around an event: centred, clamped to the series, containing the event.

    ``events`` has one row per key with times relative to the first frame.
    """
    keys = list(keys)
    total = F.col("last_s") - F.col("origin_s")
    width = F.least(F.greatest(F.lit(float(width_s)), F.col("end_time_s") - F.col("start_time_s")), total)
    middle = (F.col("start_time_s") + F.col("end_time_s")) / 2
    start = F.greatest(F.lit(0.0), F.least(middle - width / 2, total - width))
    asked = events.join(extent, keys).withColumns({"_from": start, "_to": start + width})
    asked = asked.select(*keys, "sample_start", "sample_end", "origin_s", "_from", "_to")
    rows = frames.withColumn("_s", seconds).join(asked, keys)
    at = F.col("_s") - F.col("origin_s")
    inside = rows.filter(at.between(F.col("_from"), F.col("_to")) | F.col(frame).between(F.col("sample_start"), F.col("sample_end")))
    return inside.groupBy(*keys).agg(
        F.least(F.min(F.when(at >= F.col("_from"), F.col(frame))), F.first("sample_start")).alias("start_frame"),
        F.greatest(F.max(F.when(at <= F.col("_to"), F.col(frame))), F.first("sample_end")).alias("end_frame"),
    )


def _widest_range(values: str, joints: int) -> Column:
    """Largest range that one joint covers within the group."""
    cells = [F.get(F.col(values), F.lit(j)) for j in range(joints)]
    return F.array_max(F.array(*[F.max(c) - F.min(c) for c in cells]))


def clean_runs(frames: Track, values: str, frame: str, seconds: Column, joints: int, config: SpikeRepair) -> DataFrame:
    """Stretches untouched by any abnormal step, with their duration and motion."""
    looked = carry(
        frames.derive({"_s": seconds}),
        prev={"_v1": F.col(values), "_s1": F.col("_s")},
        next={"_vn": F.col(values), "_sn": F.col("_s")},
    )

    def abnormal(later: Column, earlier: Column, dt: Column) -> Column:
        speed = lambda a, b: F.abs(a - b) / F.nullif(dt, F.lit(0.0))
        hit = F.zip_with(
            later, earlier, lambda a, b: (F.abs(a - b) > config.max_step_deg) | (speed(a, b) > config.max_velocity_deg_s)
        )
        return F.coalesce(F.exists(hit, lambda x: x), F.lit(False))

    touched = abnormal(F.col(values), F.col("_v1"), F.col("_s") - F.col("_s1")) | abnormal(
        F.col("_vn"), F.col(values), F.col("_sn") - F.col("_s")
    )
    marked = islands(looked.derive({"_clean": ~touched}), F.col("_clean"), frame).rows()
    runs = marked.filter(F.col("island").isNotNull()).groupBy(*frames.keys, "island").agg(
        F.min(frame).alias("run_start"),
        F.max(frame).alias("run_end"),
        F.min("_s").alias("run_from_s"),
        F.max("_s").alias("run_to_s"),
        _widest_range(values, joints).alias("motion_deg"),
    )
    return runs.filter((F.col("run_end") - F.col("run_start") >= 2) & (F.col("motion_deg") >= 1.0)).drop("island")


def normal_window(frames: Track, runs: DataFrame, values: str, frame: str, seconds: Column, joints: int, width_s: float) -> DataFrame:
    """A reference window with motion from the longest clean run.

    The middle of the run is preferred; if the arm rests there, the most active
    window of the run is taken.
    """
    keys = list(frames.keys)
    order = [(F.col("run_to_s") - F.col("run_from_s")).desc(), F.col("run_start")]
    best = top_rows(runs, keys, order, 1).drop("place", "motion_deg")
    asked = F.least(F.lit(float(width_s)), F.col("run_to_s") - F.col("run_from_s"))
    start = F.col("run_from_s") + (F.col("run_to_s") - F.col("run_from_s") - asked) / 2
    best = best.withColumns({"_from": start, "_to": start + asked})
    rows = frames.df.withColumn("_s", seconds).join(best, keys)
    rows = rows.filter(F.col(frame).between(F.col("run_start"), F.col("run_end")))
    middle = rows.filter(F.col("_s").between(F.col("_from"), F.col("_to"))).groupBy(*keys).agg(
        F.min(frame).alias("start_frame"),
        F.max(frame).alias("end_frame"),
        _widest_range(values, joints).alias("motion_deg"),
    )
    good = middle.filter((F.col("end_frame") - F.col("start_frame") >= 2) & (F.col("motion_deg") >= 1.0))
    # Fallback: slide over the run in time buckets of one window width, each
    # bucket also holding the rows of the next, so buckets are independent tasks.
    rest = rows.join(good.select(*keys), keys, "left_anti")
    bucket = F.floor((F.col("_s") - F.col("run_from_s")) / width_s)
    copies = rest.withColumn("_own", bucket).withColumn("_bucket", F.explode(F.array(F.col("_own"), F.col("_own") - 1)))
    group = ", ".join(f"`{name}`" for name in [*keys, "_bucket"])
    ahead = f"OVER (PARTITION BY {group} ORDER BY _s RANGE BETWEEN CURRENT ROW AND {float(width_s)!r}D FOLLOWING)"
    cells = {f"_c{j}": F.get(F.col(values), F.lit(j)) for j in range(joints)}
    spans = [F.expr(f"max({name}) {ahead} - min({name}) {ahead}") for name in cells]
    slid = copies.withColumns(cells).withColumns(
        {"motion_deg": F.array_max(F.array(*spans)), "end_frame": F.expr(f"max(`{frame}`) {ahead}")}
    )
    slid = slid.filter(
        (F.col("_own") == F.col("_bucket")) & (F.col("end_frame") - F.col(frame) >= 2) & (F.col("motion_deg") >= 1.0)
    )
    active = slid.groupBy(*keys).agg(
        F.max_by(F.struct(F.col(frame).alias("s"), F.col("end_frame").alias("e"), "motion_deg"), F.struct("motion_deg", frame, "end_frame")).alias("_b")
    )
    active = active.select(*keys, F.col("_b.s").alias("start_frame"), F.col("_b.e").alias("end_frame"), F.col("_b.motion_deg").alias("motion_deg"))
    return good.unionByName(active)


def nearest_probe(probes: DataFrame, sources: DataFrame, keys: Sequence[str], probe_time: str, source_time: str, index: str) -> DataFrame:
    """For one probe per key: the closest source, the first one on a tie."""
    rows = sources.join(probes, list(keys))
    distance = F.abs(F.col(source_time) - F.col(probe_time))
    best = rows.groupBy(*keys).agg(
        F.min_by(F.struct(index, source_time, probe_time), F.struct(distance, F.col(index))).alias("_b")
    )
    return best.select(*keys, "_b.*", (F.col(f"_b.{source_time}") - F.col(f"_b.{probe_time}")).alias("delta_ns"))
