"""Queries on joint vectors: motion rules, audit, spikes, tracking."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemark.config import ACTION_SIGNAL, JointMotion, SpikeRepair
from telemark.functions.scalar import canonical_joint
from telemark.functions.sequence import numbered
from telemark.operators import exposure, motion, quality, replay, shared_scan, spikes
from telemark.plans.registry import Registry
from telemark.plans.tables import ARMS, JOINTS, JOINTS_SQL, PICTURES_SQL, ROBOT_SQL, joint_frames, light, read, robot_frames, row_count, settle

_registry = Registry()
query, QUERIES, ORACLES = _registry.query, _registry.queries, _registry.oracles

# The given vectors move about ten degrees a step, so limits sit where some are hit.
MOTION = JointMotion()
SIGNAL = ACTION_SIGNAL
LOWER, UPPER = -0.35, 0.35
SPIKES = SpikeRepair(max_step_deg=20.0, max_velocity_deg_s=600.0, max_anchor_delta_deg=15.0, min_correction_deg=5.0)
#: With 64 joints some joint makes such a step in nearly every frame; a reference window is looked for below these.
CALM = SpikeRepair(max_step_deg=28.0, max_velocity_deg_s=560.0)


def _bound(spark, folder):
    return row_count(spark, folder, "embeddings")


def _seconds(later, earlier):
    return later - earlier


def cells(spark, folder):
    return motion.joint_cells(joint_frames(spark, folder), "values", "frame", _seconds, "time_s", radians=True)


def limits(spark):
    """A robot description as text, matched to joint names of another spelling."""
    names = [f"arm_{'lr'[k // 7]}_j{k % 7 + 1}" if k < ARMS else f"joint_{k}" for k in range(JOINTS)]
    described = [f"arm_{'LR'[k // 7]}_joint{k % 7 + 1}" if k < ARMS else f"joint_{k}" for k in range(JOINTS)]
    joints = "".join(
        f'<joint name="{name}"><limit lower="{LOWER}" upper="{UPPER}" velocity="{0.0 if k % 7 % 2 else 7.0}"/></joint>'
        for k, name in enumerate(described)
    )
    return motion.urdf_limits(spark, f"<robot>{joints}</robot>", names, SIGNAL)


def _metric(name, prefix):
    return ", ".join(
        f"round(quantile_cont({name}, {q}), 6) AS {prefix}_{label}"
        for label, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99), ("p99_9", 0.999), ("max", 1.0))
    )


@query(
    "joint_derivatives",
    f"""WITH {JOINTS_SQL} SELECT episode, frame, joint, round(step_deg, 6) AS step_deg, round(velocity_deg_s, 6) AS velocity_deg_s,
 round(acceleration_deg_s2, 6) AS acceleration_deg_s2 FROM kin""",
)
def joint_derivatives(spark, folder):
    return settle(cells(spark, folder).select("episode", "frame", "joint", "step_deg", "velocity_deg_s", "acceleration_deg_s2"))


@query(
    "joint_quantiles",
    f"""WITH {JOINTS_SQL} SELECT episode, joint, round(min(degrees(v)), 6) AS min_deg, round(max(degrees(v)), 6) AS max_deg,
 {_metric('step_deg', 'step')}, {_metric('velocity_deg_s', 'velocity')}, {_metric('acceleration_deg_s2', 'acceleration')} FROM kin GROUP BY ALL""",
)
def joint_quantiles(spark, folder):
    return settle(motion.joint_distributions(cells(spark, folder), ["episode"], bound=_bound(spark, folder)))


_EVENTS_SQL = f"""WITH {JOINTS_SQL}, lim AS (SELECT *, CASE WHEN (joint % 7 + 1) % 2 = 1 THEN 7.0::DOUBLE ELSE radians(500.0::DOUBLE) END AS vmax,
 CASE WHEN joint < 7 THEN 'arm_l_j' || (joint % 7 + 1) WHEN joint < 14 THEN 'arm_r_j' || (joint % 7 + 1) ELSE 'joint_' || joint END AS joint_name FROM kin),
ev AS (
 SELECT episode, frame, t, joint, joint_name, 'position_limit' AS kind, 'fail' AS severity, degrees(v) AS value, degrees(CASE WHEN v < -0.35 THEN -0.35 ELSE 0.35 END::DOUBLE) AS threshold, 'deg' AS unit, NULL::DOUBLE AS recovery
 FROM lim WHERE v < -0.35::DOUBLE - radians(0.1::DOUBLE) OR v > 0.35::DOUBLE + radians(0.1::DOUBLE)
 UNION ALL SELECT episode, frame, t, joint, joint_name, 'step_discontinuity', 'warning', step_deg, 25.0, 'deg', NULL FROM lim WHERE step_deg > 25
 UNION ALL SELECT episode, frame, t, joint, joint_name, 'velocity_limit', CASE WHEN velocity_deg_s > degrees(vmax) THEN 'fail' ELSE 'warning' END, velocity_deg_s,
  CASE WHEN velocity_deg_s > degrees(vmax) THEN degrees(vmax) ELSE degrees(vmax) * 0.8::DOUBLE END, 'deg/s', NULL FROM lim WHERE velocity_deg_s > degrees(vmax) * 0.8::DOUBLE
 UNION ALL SELECT episode, frame, t, joint, joint_name, 'acceleration_limit', CASE WHEN acceleration_deg_s2 > 5000 THEN 'fail' ELSE 'warning' END, acceleration_deg_s2,
  CASE WHEN acceleration_deg_s2 > 5000 THEN 5000 ELSE 4000 END, 'deg/s^2', NULL FROM lim WHERE acceleration_deg_s2 > 4000
 UNION ALL SELECT episode, frame, t, joint, joint_name, 'single_frame_spike', 'fail', greatest(entry_deg, exit_deg), 5.0, 'deg', recovery_deg
  FROM lim WHERE entry_deg >= 5 AND exit_deg >= 5 AND recovery_deg <= 1)"""


def events(spark, folder):
    return motion.motion_events(cells(spark, folder), limits(spark), ["episode"], SIGNAL, MOTION)


@query(
    "joint_events",
    f"""{_EVENTS_SQL} SELECT episode, frame AS frame_index, round(t, 6) AS timestamp_s, joint AS joint_index, joint_name, kind, severity,
 round(value, 6) AS value, round(threshold, 6) AS threshold, unit, round(recovery, 6) AS recovery_error_deg FROM ev""",
)
def joint_events(spark, folder):
    return settle(events(spark, folder))


@query(
    "ordered_events",
    f"""{_EVENTS_SQL} SELECT row_number() OVER (ORDER BY episode, frame, joint, kind) - 1 AS place, episode, frame AS frame_index, joint AS joint_index, kind FROM ev""",
)
def ordered_events(spark, folder):
    """All events numbered in the order of the report, without one task that sees them all."""
    rows = events(spark, folder).select("episode", "frame_index", "joint_index", "kind")
    return numbered(rows, ["episode", "frame_index", "joint_index", "kind"], "place")


@query("event_counts", f"{_EVENTS_SQL} SELECT episode, kind, severity, count(*) AS events FROM ev GROUP BY ALL")
def event_counts(spark, folder):
    return motion.event_counts(events(spark, folder), ["episode"])


@query(
    "joint_status",
    f"""{_EVENTS_SQL}, c AS (SELECT episode, count(*) FILTER (severity = 'fail') AS fail_event_count, count(*) FILTER (severity = 'warning') AS warning_event_count,
 {", ".join(f"count(*) FILTER (kind = '{k}') AS {k}_count" for k in motion.EVENT_KINDS)} FROM ev GROUP BY episode),
 f AS (SELECT episode, count(*) AS frame_count FROM frames GROUP BY episode)
 SELECT f.episode, frame_count, coalesce(fail_event_count, 0) AS fail_event_count, coalesce(warning_event_count, 0) AS warning_event_count,
 {", ".join(f"coalesce({k}_count, 0) AS {k}_count" for k in motion.EVENT_KINDS)},
 CASE WHEN fail_event_count > 0 THEN 'fail' WHEN warning_event_count > 0 THEN 'warning' ELSE 'pass' END AS status FROM f LEFT JOIN c USING (episode)""",
)
def joint_status(spark, folder):
    return motion.motion_status(events(spark, folder), joint_frames(spark, folder).df, ["episode"])


@query(
    "canonical_joint_names",
    """SELECT l_orderkey, l_linenumber, 'arm_' || CASE WHEN l_linenumber % 2 = 0 THEN 'l' ELSE 'r' END || '_joint' || (l_partkey % 7 + 1) AS joint FROM lineitem""",
)
def canonical_joint_names(spark, folder):
    side = F.when(F.col("l_linenumber") % 2 == 0, "L").otherwise("R")
    spelling = F.when(F.col("l_suppkey") % 2 == 0, "joint").otherwise("j")
    raw = F.concat(F.lit("arm_"), side, F.lit("_"), spelling, (F.col("l_partkey") % 7 + 1).cast("string"))
    return read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", canonical_joint(raw).alias("joint"))


_FLAGS_SQL = f"""WITH {JOINTS_SQL}, fl AS (SELECT *, coalesce(step_deg > 25, false) AS step_over, coalesce(velocity_deg_s > 500, false) AS velocity_over,
 coalesce(velocity_deg_s > 400 AND velocity_deg_s <= 500, false) AS velocity_near, coalesce(acceleration_deg_s2 > 5000, false) AS acceleration_over,
 coalesce(acceleration_deg_s2 > 4000 AND acceleration_deg_s2 <= 5000, false) AS acceleration_near,
 coalesce(entry_deg >= 5 AND exit_deg >= 5 AND recovery_deg <= 1, false) AS spike FROM kin), flg AS (SELECT *, step_over OR velocity_over AS jump FROM fl)"""


def flagged(spark, folder):
    """The audit reads raw degrees, so vectors are converted before the derivatives."""
    frames = joint_frames(spark, folder)
    raw = motion.joint_cells(frames, "degrees", "frame", _seconds, "time_s", radians=False)
    return motion.audit_flags(raw, SIGNAL, MOTION)


@query(
    "joint_audit",
    f"""{_FLAGS_SQL} SELECT episode, joint, round(min(degrees(v)), 6) AS min_deg, round(max(degrees(v)), 6) AS max_deg, round(stddev_pop(degrees(v)), 6) AS std_deg,
 max(degrees(v)) - min(degrees(v)) < 1e-8 AS constant, round(max(step_deg), 6) AS max_step_deg, round(max(velocity_deg_s), 6) AS max_velocity_deg_s,
 round(max(acceleration_deg_s2), 6) AS max_acceleration_deg_s2, count(*) FILTER (jump) AS jump_edge_count, count(*) FILTER (acceleration_over) AS acceleration_over_count,
 count(*) FILTER (spike) AS single_frame_spike_count FROM flg GROUP BY ALL""",
)
def joint_audit(spark, folder):
    return settle(motion.audit_joints(flagged(spark, folder), ["episode"]))


@query(
    "audit_events",
    f"""{_FLAGS_SQL}, e AS (
 SELECT episode, joint, 'joint_jump' AS kind, 'review' AS severity, frame - 1 AS from_frame, frame AS to_frame, step_deg AS value, 25.0::DOUBLE AS threshold FROM flg WHERE jump
 UNION ALL SELECT episode, joint, 'velocity_near_limit', 'warning', frame - 1, frame, velocity_deg_s, 400.0 FROM flg WHERE velocity_near
 UNION ALL SELECT episode, joint, 'acceleration', CASE WHEN acceleration_over THEN 'review' ELSE 'warning' END, frame - 2, frame, acceleration_deg_s2, CASE WHEN acceleration_over THEN 5000.0 ELSE 4000.0 END FROM flg WHERE acceleration_over OR acceleration_near
 UNION ALL SELECT episode, joint, 'single_frame_spike', 'review', frame - 1, frame + 1, greatest(entry_deg, exit_deg), 5.0 FROM flg WHERE spike)
 SELECT episode, joint, kind, severity, from_frame, to_frame, round(value, 6) AS value, round(threshold, 6) AS threshold FROM e""",
)
def audit_events(spark, folder):
    return settle(motion.audit_events(flagged(spark, folder), ["episode"], SIGNAL, MOTION))


@query(
    "audit_status",
    f"""{_FLAGS_SQL}, tt AS (SELECT episode, round(max(step_deg), 6) AS max_step_deg, round(max(velocity_deg_s), 6) AS max_velocity_deg_s, round(max(acceleration_deg_s2), 6) AS max_acceleration_deg_s2,
 {", ".join(f"count(*) FILTER ({k}) AS {k}_count" for k in ("jump", "step_over", "velocity_over", "velocity_near", "acceleration_over", "acceleration_near", "spike"))} FROM flg GROUP BY episode),
 ck AS (SELECT *, 0::BIGINT AS nonpositive_count, 0::BIGINT AS near_duplicate_count, 0::BIGINT AS gap_count, 0::BIGINT AS severe_gap_count FROM tt)
 SELECT *, CASE WHEN jump_count > 0 OR acceleration_over_count > 0 OR spike_count > 0 THEN 'review' WHEN velocity_near_count > 0 OR acceleration_near_count > 0 THEN 'warning' ELSE 'clean_under_checked_thresholds' END AS status FROM ck""",
)
def audit_status(spark, folder):
    frames = joint_frames(spark, folder)
    clock = motion.audit_gaps(frames.derive({"ns": F.col("time_ns").cast("bigint")}), "ns", "frame", F.lit(120.0))
    return settle(motion.audit_summary(flagged(spark, folder), clock, ["episode"]))


@query(
    "largest_step",
    f"""WITH {JOINTS_SQL} SELECT episode, joint, frame - 1 AS from_frame, frame AS to_frame, round(degrees(v1), 6) AS from_value, round(degrees(v), 6) AS to_value, round(degrees(v) - degrees(v1), 6) AS signed_step_deg
 FROM kin WHERE step_deg IS NOT NULL QUALIFY row_number() OVER (PARTITION BY episode ORDER BY abs(degrees(v) - degrees(v1)) DESC, frame, joint) = 1""",
)
def largest_step(spark, folder):
    return settle(motion.largest_step(flagged(spark, folder), ["episode"]))


@query(
    "array_metrics",
    """WITH x AS (SELECT label AS episode, j - 1 AS dimension, CASE WHEN (vec_id + j) % 37 = 0 THEN 'nan'::DOUBLE ELSE embedding[j]::DOUBLE END AS v, (vec_id + j) % 41 = 0 AND (vec_id + j) % 37 <> 0 AS inf_ FROM embeddings, generate_series(1, 64) g(j))
 SELECT episode, dimension, count(*) AS cells, count(*) FILTER (isnan(v)) AS nan_count, 0::BIGINT AS inf_count, round(count(*) FILTER (NOT isnan(v)) / count(*)::DOUBLE, 6) AS finite_ratio,
 round(min(v) FILTER (NOT isnan(v)), 6) AS min_value, round(max(v) FILTER (NOT isnan(v)), 6) AS max_value, round(avg(v) FILTER (NOT isnan(v)), 6) AS mean_value,
 round(stddev_pop(v) FILTER (NOT isnan(v)), 6) AS std_value, coalesce(stddev_pop(v) FILTER (NOT isnan(v)) < 1e-8, false) AS constant FROM x GROUP BY ALL""",
)
def array_metrics(spark, folder):
    """Per dimension statistics of vectors with missing readings."""
    rows = read(spark, folder, "embeddings").select(
        F.col("label").alias("episode"),
        F.transform(
            F.col("embedding").cast("array<double>"),
            lambda x, i: F.when((F.col("vec_id") + i + 1) % 37 == 0, float("nan")).otherwise(x),
        ).alias("vector"),
    )
    return settle(quality.array_metrics(rows, ["episode"], "vector"))


# --- spikes ---

def _spike_sql(step: int, speed: int) -> str:
    return f"""WITH {JOINTS_SQL}, deg AS (SELECT episode, joint, frame, t, degrees(v) AS d FROM cell0),
e AS (SELECT *, lag(d) OVER w AS d1, lag(t) OVER w AS t1 FROM deg WINDOW w AS (PARTITION BY episode, joint ORDER BY frame)),
bad AS (SELECT episode, joint, frame - 1 AS edge, t1, t, d1, d, abs(d - d1) AS step, abs((d - d1) / (t - t1)) AS vel FROM e WHERE abs(d - d1) > {step} OR abs((d - d1) / (t - t1)) > {speed}),
ext AS (SELECT episode, count(*) AS n FROM frames GROUP BY episode),
grp AS (SELECT *, edge - row_number() OVER (PARTITION BY episode, joint ORDER BY edge) AS g FROM bad),
rn AS (SELECT episode, joint, g, min(edge) AS s, max(edge) + 1 AS r, min(t1) AS ts, max(t) AS te, max(step) AS mstep, max(vel) AS mvel, arg_min(d1, edge) AS lv, arg_max(d, edge) AS rv FROM grp GROUP BY ALL),
res AS (SELECT rn.episode, rn.joint, rn.g, max(abs(x.d - (lv + (x.frame - s) * ((rv - lv) / (r - s))))) AS residual FROM rn JOIN deg x ON x.episode = rn.episode AND x.joint = rn.joint AND x.frame > s AND x.frame < r GROUP BY ALL),
jd AS (SELECT rn.*, n, r - s - 1 AS interior, coalesce(residual, 0) AS residual,
 CASE WHEN s = 0 OR r >= n - 1 THEN 'boundary_event' WHEN r - s - 1 = 0 THEN 'persistent_step' WHEN r - s - 1 > 6 THEN 'run_too_long'
 WHEN abs(rv - lv) > 15 THEN 'persistent_step' WHEN residual < 5 THEN 'small_interpolation_residual' END AS reason FROM rn JOIN ext USING (episode) LEFT JOIN res USING (episode, joint, g))"""


_SPIKE_SQL = _spike_sql(20, 600)


def _extent(frames):
    return frames.groupBy("episode").agg(F.count("*").alias("frames"), F.min("time_s").alias("origin_s"), F.max("time_s").alias("last_s"))


def _edges(spark, folder):
    return spikes.joint_edges(joint_frames(spark, folder), "degrees", "frame", F.col("time_s"), SPIKES)


def _runs(spark, folder):
    frames = joint_frames(spark, folder).df
    return spikes.spike_runs(_edges(spark, folder), _extent(frames), ["episode"], SPIKES, bound=_bound(spark, folder))


@query(
    "spike_repair_events",
    f"""{_SPIKE_SQL} SELECT episode, joint, s AS start_frame, r AS end_frame, round(ts, 6) AS start_time_s, round(te, 6) AS end_time_s, round(mstep, 6) AS max_step_deg, round(mvel, 6) AS max_velocity_deg_s,
 round(CASE WHEN s = 0 OR r >= n - 1 OR interior = 0 OR interior > 6 THEN 0 ELSE residual END, 6) AS max_interpolation_residual_deg,
 CASE WHEN reason IS NULL THEN 'linear_interpolation' ELSE 'manual_review' END AS method, reason FROM jd""",
)
def spike_repair_events(spark, folder):
    return settle(_runs(spark, folder).drop("left_value", "right_value"))


@query(
    "spike_repair_values",
    f"""{_SPIKE_SQL} SELECT x.episode, x.joint, x.frame, round(lv + (x.frame - s) * ((rv - lv) / (r - s)), 6) AS corrected
 FROM jd JOIN deg x ON x.episode = jd.episode AND x.joint = jd.joint AND x.frame > s AND x.frame < r WHERE reason IS NULL""",
)
def spike_repair_values(spark, folder):
    return settle(spikes.repaired_cells(_runs(spark, folder), ["episode"], SPIKES))


@query(
    "spike_repaired_frames",
    f"""{_SPIKE_SQL}, fix AS (SELECT x.episode, x.joint, x.frame, lv + (x.frame - s) * ((rv - lv) / (r - s)) AS c
 FROM jd JOIN deg x ON x.episode = jd.episode AND x.joint = jd.joint AND x.frame > s AND x.frame < r WHERE reason IS NULL)
 SELECT d.episode, d.frame, d.joint, round(coalesce(c, d.d), 6) AS value FROM deg d LEFT JOIN fix USING (episode, joint, frame)""",
)
def spike_repaired_frames(spark, folder):
    cells_ = spikes.repaired_cells(_runs(spark, folder), ["episode"], SPIKES)
    frames = joint_frames(spark, folder).rows().select("episode", "frame", "degrees")
    whole = spikes.corrected_frames(frames, cells_, ["episode"], "degrees", "frame")
    return settle(whole.select("episode", "frame", F.posexplode("degrees").alias("joint", "value")))


@query(
    "spike_status",
    f"""{_SPIKE_SQL}, c AS (SELECT episode, count(*) FILTER (reason IS NULL) AS rep, count(*) FILTER (reason IS NOT NULL) AS rev, coalesce(sum(interior) FILTER (reason IS NULL), 0)::BIGINT AS ch FROM jd GROUP BY episode)
 SELECT episode, coalesce(rep, 0) AS repair_event_count, coalesce(rev, 0) AS review_event_count, coalesce(ch, 0) AS changed_value_count,
 CASE WHEN rev > 0 THEN 'review' WHEN ch > 0 THEN 'repaired' ELSE 'clean' END AS status FROM ext LEFT JOIN c USING (episode)""",
)
def spike_status(spark, folder):
    runs = _runs(spark, folder)
    return spikes.spike_status(runs, spikes.repaired_cells(runs, ["episode"], SPIKES), _extent(joint_frames(spark, folder).df), ["episode"])


_MERGED_SQL = f"""{_SPIKE_SQL}, fr AS (SELECT episode, edge, min(t1) AS t1, max(t) AS t, max(step) AS step, max(vel) AS vel FROM bad GROUP BY ALL),
mg AS (SELECT *, edge - row_number() OVER (PARTITION BY episode ORDER BY edge) AS m FROM fr),
mr AS (SELECT episode, m, min(edge) AS s, max(edge) AS e, min(t1) AS ts, max(t) AS te, max(step) AS mstep, max(vel) AS mvel FROM mg GROUP BY ALL),
jn AS (SELECT mr.episode, mr.m, string_agg(DISTINCT b.joint::VARCHAR, ',' ORDER BY b.joint::VARCHAR) AS joints FROM mr JOIN bad b ON b.episode = mr.episode AND b.edge BETWEEN mr.s AND mr.e GROUP BY ALL)"""


@query(
    "jump_runs_merged",
    f"""{_MERGED_SQL} SELECT episode, s AS edge_start, e AS edge_end, s AS sample_start, e + 1 AS sample_end, round(ts, 6) AS start_time_s, round(te, 6) AS end_time_s,
 round(mstep, 6) AS max_step_deg, round(mvel, 6) AS max_velocity_deg_s, joints FROM mr JOIN jn USING (episode, m)""",
)
def jump_runs_merged(spark, folder):
    merged = spikes.merged_jumps(_edges(spark, folder), ["episode"], bound=_bound(spark, folder) * JOINTS)
    as_text = F.array_join(F.array_sort(F.transform("joints", lambda j: j.cast("string"))), ",")
    return settle(merged.withColumn("joints", as_text))


@query(
    "strongest_jump",
    f"""{_MERGED_SQL} SELECT episode, s AS edge_start, e AS edge_end, round(mstep, 6) AS max_step_deg FROM mr
 QUALIFY row_number() OVER (PARTITION BY episode ORDER BY mstep DESC, mvel DESC, s) = 1""",
)
def strongest_jump(spark, folder):
    merged = spikes.merged_jumps(_edges(spark, folder), ["episode"], bound=_bound(spark, folder) * JOINTS)
    return settle(spikes.strongest_jump(merged, ["episode"]).select("episode", "edge_start", "edge_end", "max_step_deg"))


@query(
    "abnormal_window",
    f"""{_MERGED_SQL}, best AS (SELECT * FROM mr QUALIFY row_number() OVER (PARTITION BY episode ORDER BY mstep DESC, mvel DESC, s) = 1),
 tot AS (SELECT episode, max(frame) / 20.0::DOUBLE AS total FROM frames GROUP BY episode),
 wd AS (SELECT *, least(greatest(0.4::DOUBLE, te - ts), total) AS width FROM best JOIN tot USING (episode)),
 ask AS (SELECT *, greatest(0.0::DOUBLE, least((ts + te) / 2 - width / 2, total - width)) AS a FROM wd)
 SELECT k.episode, least(min(frame) FILTER (frame / 20.0::DOUBLE >= a), first(s)) AS start_frame, greatest(max(frame) FILTER (frame / 20.0::DOUBLE <= a + width), first(e) + 1) AS end_frame
 FROM ask k JOIN frames f ON f.episode = k.episode GROUP BY k.episode""",
)
def abnormal_window(spark, folder):
    frames = joint_frames(spark, folder).rows()
    merged = spikes.merged_jumps(_edges(spark, folder), ["episode"], bound=_bound(spark, folder) * JOINTS)
    best = spikes.strongest_jump(merged, ["episode"])
    return spikes.abnormal_window(frames, best, _extent(frames), ["episode"], "frame", F.col("time_s"), 0.4)


def _clean_sql(spikes_sql: str) -> str:
    return f"""{spikes_sql}, touched AS (SELECT DISTINCT episode, edge AS frame FROM bad UNION SELECT DISTINCT episode, edge + 1 FROM bad),
ok AS (SELECT f.episode, f.frame, f.frame - row_number() OVER (PARTITION BY f.episode ORDER BY f.frame) AS c FROM frames f ANTI JOIN touched t ON f.episode = t.episode AND f.frame = t.frame),
cj AS (SELECT ok.episode, c, joint, min(ok.frame) AS s, max(ok.frame) AS e, max(d) - min(d) AS span FROM ok JOIN deg USING (episode, frame) GROUP BY ALL),
cr AS (SELECT episode, min(s) AS s, max(e) AS e, max(span) AS motion FROM cj GROUP BY episode, c),
cg AS (SELECT * FROM cr WHERE e - s >= 2 AND motion >= 1)"""


_CLEAN_SQL = _clean_sql(_SPIKE_SQL)


@query(
    "clean_runs",
    f"{_CLEAN_SQL} SELECT episode, s AS run_start, e AS run_end, round(s / 20.0, 6) AS run_from_s, round(e / 20.0, 6) AS run_to_s, round(motion, 6) AS motion_deg FROM cg",
)
def clean_runs(spark, folder):
    return settle(spikes.clean_runs(joint_frames(spark, folder), "degrees", "frame", F.col("time_s"), JOINTS, SPIKES))


@query(
    "normal_window",
    f"""{_clean_sql(_spike_sql(28, 560))}, best AS (SELECT * FROM cg QUALIFY row_number() OVER (PARTITION BY episode ORDER BY e / 20.0::DOUBLE - s / 20.0::DOUBLE DESC, s) = 1),
 wd AS (SELECT *, least(0.3::DOUBLE, e / 20.0::DOUBLE - s / 20.0::DOUBLE) AS width FROM best), ask AS (SELECT *, s / 20.0::DOUBLE + (e / 20.0::DOUBLE - s / 20.0::DOUBLE - width) / 2 AS a FROM wd),
 pick AS (SELECT k.episode, min(frame) AS s, max(frame) AS e FROM ask k JOIN frames f ON f.episode = k.episode AND f.frame BETWEEN k.s AND k.e AND f.frame / 20.0::DOUBLE BETWEEN a AND a + width GROUP BY k.episode),
 mo AS (SELECT p.episode, p.s, p.e, joint, max(d) - min(d) AS span FROM pick p JOIN deg ON deg.episode = p.episode AND deg.frame BETWEEN p.s AND p.e GROUP BY ALL)
 SELECT episode, s AS start_frame, e AS end_frame, round(max(span), 6) AS motion_deg FROM mo GROUP BY ALL HAVING e - s >= 2 AND max(span) >= 1""",
)
def normal_window(spark, folder):
    frames = joint_frames(spark, folder)
    runs = spikes.clean_runs(frames, "degrees", "frame", F.col("time_s"), JOINTS, CALM)
    return settle(spikes.normal_window(frames, runs, "degrees", "frame", F.col("time_s"), JOINTS, 0.3))


@query(
    "nearest_probe",
    f"""{_MERGED_SQL}, best AS (SELECT * FROM mr QUALIFY row_number() OVER (PARTITION BY episode ORDER BY mstep DESC, mvel DESC, s) = 1),
 pb AS (SELECT episode, s * 50000000 AS probe_ns FROM best), im AS (SELECT label AS episode, vec_id, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) * 33333000 AS image_ns FROM embeddings)
 SELECT episode, vec_id, image_ns, probe_ns, image_ns - probe_ns AS delta_ns FROM im JOIN pb USING (episode)
 QUALIFY row_number() OVER (PARTITION BY episode ORDER BY abs(image_ns - probe_ns), vec_id) = 1""",
)
def nearest_probe(spark, folder):
    """The picture closest in time to the strongest jump of its episode."""
    merged = spikes.merged_jumps(_edges(spark, folder), ["episode"], bound=_bound(spark, folder) * JOINTS)
    probes = spikes.strongest_jump(merged, ["episode"]).select("episode", (F.col("edge_start") * 50_000_000).alias("probe_ns"))
    images = joint_frames(spark, folder).rows().select("episode", "vec_id", (F.col("frame") * 33_333_000).alias("image_ns"))
    return spikes.nearest_probe(probes, images, ["episode"], "probe_ns", "image_ns", "vec_id")


# --- converted frames ---

_TRACK_SQL = f"WITH {ROBOT_SQL}, tk AS (SELECT episode, frame, dimension AS joint, degrees(abs(action - state)::DOUBLE) AS err FROM robot WHERE dimension < 14)"


def _tracking(spark, folder):
    return quality.tracking_cells(robot_frames(spark, folder).df, ["episode"], "state", "action")


@query(
    "tracking_error",
    f"{_TRACK_SQL} SELECT episode, joint, round(max(err), 4) AS max_abs_deg, round(quantile_cont(err, 0.5), 4) AS median_abs_deg, round(quantile_cont(err, 0.95), 4) AS p95_abs_deg FROM tk GROUP BY ALL",
)
def tracking_error(spark, folder):
    return settle(quality.tracking_error(_tracking(spark, folder), ["episode"], bound=_bound(spark, folder)), 4)


@query(
    "tracking_totals",
    f"""{_TRACK_SQL}, j AS (SELECT episode, joint, quantile_cont(err, 0.95) AS p FROM tk GROUP BY ALL), w AS (SELECT episode, round(max(p), 4) AS worst_joint_p95_deg FROM j GROUP BY episode)
 SELECT * FROM (SELECT episode, round(max(err), 4) AS max_abs_deg, round(quantile_cont(err, 0.95), 4) AS global_p95_abs_deg FROM tk GROUP BY episode) JOIN w USING (episode)""",
)
def tracking_totals(spark, folder):
    return settle(quality.tracking_totals(_tracking(spark, folder), ["episode"], bound=_bound(spark, folder) * JOINTS), 4)


_STEP_SQL = f"""WITH {ROBOT_SQL}, st AS (SELECT *, abs(action - lag(action) OVER (PARTITION BY episode, dimension ORDER BY frame)) AS s FROM robot WHERE dimension < 14),
fs AS (SELECT episode, frame AS output_frame, degrees(max(s)::DOUBLE) AS m FROM st WHERE s IS NOT NULL GROUP BY ALL)"""


def _steps(spark, folder):
    return quality.action_steps(robot_frames(spark, folder), "action", "frame")


@query(
    "action_quality",
    f"{_STEP_SQL} SELECT episode, round(max(m), 4) AS max_arm_action_step_deg, count(*) FILTER (m > 25) AS jump_count FROM fs GROUP BY episode",
)
def action_quality(spark, folder):
    return settle(quality.action_quality(_steps(spark, folder), ["episode"], 25.0), 4)


@query(
    "action_jumps_top10",
    f"""{_STEP_SQL} SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY m DESC, output_frame DESC) AS place, output_frame, round(m, 4) AS max_joint_step_deg FROM fs
 QUALIFY row_number() OVER (PARTITION BY episode ORDER BY m DESC, output_frame DESC) <= 10""",
)
def action_jumps_top10(spark, folder):
    return settle(quality.largest_jumps(_steps(spark, folder), ["episode"]), 4)


@query(
    "vector_ranges",
    f"""WITH {ROBOT_SQL} SELECT episode, 'state' AS vector, dimension, round(min(state), 4) AS min_value, round(max(state), 4) AS max_value FROM robot GROUP BY ALL
 UNION ALL SELECT episode, 'action', dimension, round(min(action), 4), round(max(action), 4) FROM robot GROUP BY ALL""",
)
def vector_ranges(spark, folder):
    return settle(quality.vector_ranges(robot_frames(spark, folder).df, ["episode"], ["state", "action"]), 4)


@query(
    "tcp_scale",
    """WITH x AS (SELECT label AS episode, abs(embedding[j]::DOUBLE * 1000) AS m, abs(embedding[j + 6]::DOUBLE) AS l FROM embeddings, generate_series(1, 3) g(j)),
 q AS (SELECT episode, quantile_cont(m, 0.5) AS m, quantile_cont(l, 0.5) AS l FROM x GROUP BY episode)
 SELECT episode, round(m, 6) AS measured_translation_median_abs, round(l, 6) AS lead_translation_median_abs, round(m / greatest(l, 1e-12), 3) AS translation_scale_ratio FROM q""",
)
def tcp_scale(spark, folder):
    frames = joint_frames(spark, folder).df
    measured = F.transform("vector", lambda x: x * 1000)
    scale = quality.tcp_scale(frames, ["episode"], measured, F.slice("vector", 7, 6), bound=_bound(spark, folder) * 3)
    return settle(scale.withColumn("translation_scale_ratio", F.round("translation_scale_ratio", 3)))


@query(
    "orientation_step",
    """WITH x AS (SELECT label AS episode, j, degrees(embedding[j]::DOUBLE) - lag(degrees(embedding[j]::DOUBLE)) OVER (PARTITION BY label, j ORDER BY vec_id) AS s FROM embeddings, generate_series(10, 12) g(j))
 SELECT episode, round(coalesce(max(abs(s)), 0), 6) AS lead_orientation_max_step FROM x GROUP BY episode""",
)
def orientation_step(spark, folder):
    tool = joint_frames(spark, folder).derive({"tool": F.transform(F.slice("vector", 7, 6), lambda x: F.degrees(x))})
    return settle(quality.orientation_step(tool, "tool"))


# --- replay ---

@query(
    "replay_slice",
    f"WITH {ROBOT_SQL} SELECT episode, frame, dimension AS joint, round(action, 4) AS target FROM robot WHERE dimension < 14 AND frame >= 5 AND frame < 40 AND (frame - 5) % 3 = 0",
)
def replay_slice(spark, folder):
    chosen = replay.select_frames(robot_frames(spark, folder).rows(), "frame", start=5, end=40, stride=3)
    return settle(chosen.select("episode", "frame", F.posexplode(F.slice("action", 1, ARMS)).alias("joint", "target")), 4)


_CLIP_SQL = f"""WITH {ROBOT_SQL}, c AS (SELECT episode, frame, dimension AS joint, action::DOUBLE AS a, greatest(-0.3::DOUBLE, least(0.3::DOUBLE, action::DOUBLE)) AS cl FROM robot WHERE dimension < 14)"""


@query(
    "replay_limit_violations",
    f"{_CLIP_SQL} SELECT episode, joint, count(*) AS violations, round(max(abs(degrees(a - cl))), 4) AS max_violation_deg FROM c WHERE abs(a - cl) > 1e-6 GROUP BY ALL",
)
def replay_limit_violations(spark, folder):
    frames = robot_frames(spark, folder).rows().withColumn("targets", F.slice("action", 1, ARMS).cast("array<double>"))
    found = replay.limit_violations(frames, ["episode"], "frame", "targets", F.lit(-0.3), F.lit(0.3))
    return settle(found, 4)


@query(
    "replay_summary",
    f"""{_STEP_SQL}, n AS (SELECT episode, count(*) AS frames, round((max(frame) - min(frame)) / 20.0, 6) AS duration_s FROM (SELECT DISTINCT episode, frame FROM robot) GROUP BY episode)
 SELECT episode, frames, duration_s, round(max(m), 4) AS max_step_deg FROM n JOIN fs USING (episode) GROUP BY ALL""",
)
def replay_summary(spark, folder):
    return settle(replay.trajectory_summary(robot_frames(spark, folder), "action", "frame", "time_s"), 4)


@query(
    "replay_error",
    f"""WITH {ROBOT_SQL} SELECT episode, round(degrees(sqrt(avg(power(action::DOUBLE - state::DOUBLE, 2)))), 4) AS rmse_deg, round(degrees(max(abs(action::DOUBLE - state::DOUBLE))), 4) AS max_error_deg FROM robot WHERE dimension < 14 GROUP BY episode""",
)
def replay_error(spark, folder):
    return settle(replay.final_error(robot_frames(spark, folder).df, ["episode"], "action", "state"), 4)


def _upsample_sql(value: str) -> str:
    return f"""WITH {ROBOT_SQL}, nx AS (SELECT episode, frame, dimension, action::DOUBLE AS a, lead(action::DOUBLE) OVER (PARTITION BY episode, dimension ORDER BY frame) AS b FROM robot WHERE dimension < 14)
 SELECT episode, frame, k AS substep, dimension AS joint, round({value}, 4) AS target FROM nx, generate_series(1, 5) g(k) WHERE b IS NOT NULL"""


@query("upsample_linear", _upsample_sql("a + (b - a) * (k / 5.0::DOUBLE)"))
def upsample_linear(spark, folder):
    return _upsampled(spark, folder, "linear")


@query("upsample_hold", _upsample_sql("a"))
def upsample_hold(spark, folder):
    return _upsampled(spark, folder, "hold")


def _upsampled(spark, folder, mode):
    frames = robot_frames(spark, folder).derive({"targets": F.slice("action", 1, ARMS).cast("array<double>")})
    dense = replay.upsample(frames, "targets", "frame", "time_s", step_s=0.01, mode=mode)
    return settle(dense.select("episode", "frame", "substep", F.posexplode("target").alias("joint", "target")), 4)


# --- operators that share one scan ---

_SHARED_SQL = f"""{_EVENTS_SQL}, {PICTURES_SQL},
 stp AS (SELECT episode, frame, max(step_deg) AS m FROM kin WHERE joint < 14 AND step_deg IS NOT NULL GROUP BY ALL)
 SELECT episode, 'motion' AS operator, kind AS measure, count(*)::DOUBLE AS amount FROM ev GROUP BY ALL
 UNION ALL SELECT episode, 'action', 'jumps', count(*) FILTER (m > 25)::DOUBLE FROM stp GROUP BY ALL
 UNION ALL SELECT episode, 'action', 'largest_step_deg', round(max(m), 4) FROM stp GROUP BY ALL
 UNION ALL SELECT camera, 'exposure', 'candidates', count(*) FILTER (candidate)::DOUBLE FROM judged GROUP BY ALL
 UNION ALL SELECT camera, 'exposure', 'confirmed', count(*) FILTER (confirmed)::DOUBLE FROM judged GROUP BY ALL"""


def _shared(spark, folder):
    frames = joint_frames(spark, folder).derive({"light": light("vector")})
    frames = frames.derive(exposure.luminance_metrics(F.col("light")))
    operators = shared_scan.chosen(
        {
            "motion": {"vector": "values", "time": "time_s", "limits": limits(spark), "signal": SIGNAL, "config": MOTION},
            "action": {"vector": "values"},
            "exposure": {},
        }
    )
    return shared_scan.shared_scan(frames, "frame", operators)


@query("shared_scan", _SHARED_SQL)
def shared_scan_measures(spark, folder):
    """Motion, action and exposure operators on one scan and one shuffle of the frames."""
    found = _shared(spark, folder)

    def measure(rows, operator, name, amount):
        return rows.select("episode", F.lit(operator).alias("operator"), name.alias("measure"), amount.cast("double").alias("amount"))

    kinds = found["motion"]["events"].groupBy("episode", "kind").agg(F.count("*").alias("n"))
    steps, cameras = found["action"]["steps"], found["exposure"]["cameras"]
    merged = measure(kinds, "motion", F.col("kind"), F.col("n"))
    for more in (
        measure(steps, "action", F.lit("jumps"), F.col("jump_count")),
        measure(steps, "action", F.lit("largest_step_deg"), F.round("max_arm_action_step_deg", 4)),
        measure(cameras, "exposure", F.lit("candidates"), F.col("candidate_frames")),
        measure(cameras, "exposure", F.lit("confirmed"), F.col("confirmed_frames")),
    ):
        merged = merged.unionByName(more)
    return merged


@query(
    "shared_verdicts",
    f"""{_EVENTS_SQL}, {PICTURES_SQL}, worst AS (SELECT episode, count(*) FILTER (severity = 'fail') AS f, count(*) AS n FROM ev GROUP BY ALL)
 SELECT e.episode, 'motion' AS operator, CASE WHEN f > 0 THEN 'fail' WHEN n > 0 THEN 'warning' ELSE 'pass' END AS status
 FROM (SELECT DISTINCT episode FROM frames) e LEFT JOIN worst USING (episode)
 UNION ALL SELECT camera, 'exposure', CASE WHEN count(*) FILTER (confirmed) > 0 THEN 'warning' ELSE 'pass' END FROM judged GROUP BY ALL""",
)
def shared_verdicts(spark, folder):
    return shared_scan.verdicts(_shared(spark, folder), ["episode"])
