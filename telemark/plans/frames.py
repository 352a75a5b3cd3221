"""Queries on pictures, values, labels and texts: exposure, sampling, risks, detections."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemark.config import Exposure
from telemark.functions.scalar import clip
from telemark.operators import conversion, detection, exposure, images, quality
from telemark.plans import joints, streams
from telemark.plans.registry import Registry
from telemark.plans.tables import MESSAGES_SQL, PICTURES_SQL, ROBOT_SQL, pictures, read, robot_frames, row_count, settle, stamp_ns, stream

_registry = Registry()
query, QUERIES, ORACLES = _registry.query, _registry.queries, _registry.oracles

EXPOSURE = Exposure()


def _shots(spark, folder):
    frames = pictures(spark, folder)
    return frames.derive(exposure.luminance_metrics(F.col("light"), EXPOSURE)).derive(exposure.candidate_flags(EXPOSURE))


def _confirmed(spark, folder):
    return exposure.confirmed_frames(_shots(spark, folder), "frame_index", EXPOSURE)


@query(
    "luminance_percentiles",
    f"WITH {PICTURES_SQL} SELECT camera, frame_index, round(l50, 6) AS l50, round(l95, 6) AS l95, round(highlight_clipping_ratio, 6) AS highlight_clipping_ratio FROM shot",
)
def luminance_percentiles(spark, folder):
    return settle(_shots(spark, folder).rows().select("camera", "frame_index", *exposure.METRICS))


@query(
    "exposure_candidates",
    f"WITH {PICTURES_SQL} SELECT camera, frame_index, broad_overexposure_candidate, highlight_clipping_candidate, candidate, confirmed FROM judged",
)
def exposure_candidates(spark, folder):
    return _confirmed(spark, folder).select(
        "camera", "frame_index", "broad_overexposure_candidate", "highlight_clipping_candidate", "candidate", "confirmed"
    )


@query(
    "exposure_segments",
    f"""WITH {PICTURES_SQL} SELECT camera, min(frame_index) AS start_frame, max(frame_index) AS end_frame, count(*) AS frame_count,
 count(*) FILTER (broad_overexposure_candidate) AS broad_overexposure_frame_count, count(*) FILTER (highlight_clipping_candidate) AS highlight_clipping_frame_count,
 round(max(l50), 6) AS max_l50, round(max(l95), 6) AS max_l95, round(max(highlight_clipping_ratio), 6) AS max_highlight_clipping_ratio,
 arg_min(vec_id, frame_index) AS start_vec_id, arg_max(vec_id, frame_index) AS end_vec_id
 FROM judged JOIN (SELECT camera, frame_index, vec_id FROM shots) USING (camera, frame_index) WHERE confirmed GROUP BY camera, run""",
)
def exposure_segments(spark, folder):
    return settle(exposure.exposure_segments(_confirmed(spark, folder), ["camera"], "frame_index", ["vec_id"]))


def _spread(metric):
    return ", ".join(
        f"round(quantile_cont({metric}, {q}), 6) AS {metric}_{label}" for label, q in exposure.DISTRIBUTION.items()
    )


@query(
    "exposure_distribution",
    f"""WITH {PICTURES_SQL} SELECT camera, count(*) AS analyzed_frames, count(*) FILTER (candidate) AS candidate_frames, count(*) FILTER (confirmed) AS confirmed_frames,
 {", ".join(_spread(m) for m in exposure.METRICS)} FROM judged GROUP BY camera""",
)
def exposure_distribution(spark, folder):
    return settle(exposure.exposure_summary(_confirmed(spark, folder), ["camera"], bound=row_count(spark, folder, "embeddings")))


@query(
    "exposure_status",
    f"WITH {PICTURES_SQL} SELECT camera, CASE WHEN bool_or(confirmed) THEN 'warning' ELSE 'pass' END AS status FROM judged GROUP BY camera",
)
def exposure_status(spark, folder):
    return exposure.exposure_status(_confirmed(spark, folder), ["camera"])


# --- sampling and content ---

@query(
    "uniform_sample",
    """WITH d AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents),
 w AS (SELECT source, n, least(12, n) AS k FROM d GROUP BY ALL), p AS (SELECT DISTINCT source, floor(s * ((n - 1) / greatest(k - 1, 1)::DOUBLE))::BIGINT AS i FROM w, generate_series(0, 11) g(s) WHERE s < k)
 SELECT source, i AS frame, doc_id FROM d JOIN p USING (source, i)""",
)
def uniform_sample(spark, folder):
    """Twelve evenly spaced documents per source."""
    from telemark.functions.sequence import carry, track

    rows = read(spark, folder, "documents").select("source", "doc_id")
    line = track(rows, ["source"], ["doc_id"], bound=row_count(spark, folder, "documents"))
    numbered = carry(line, number="frame").rows()
    return images.uniform_sample(numbered, ["source"], "frame", 12).select("source", "frame", "doc_id")


@query(
    "hash_duplicates",
    """WITH h AS (SELECT source, md5(text) AS h, count(*) AS c FROM documents GROUP BY ALL)
 SELECT source, count(*) AS unique_hashes, sum(c - 1)::BIGINT AS duplicate_hashes FROM h GROUP BY source""",
)
def hash_duplicates(spark, folder):
    return images.hash_duplicates(read(spark, folder, "documents"), ["source"], F.col("text").cast("binary"))


@query(
    "encoded_sizes",
    """SELECT source, min(octet_length(encode(text))) AS min_bytes, max(octet_length(encode(text))) AS max_bytes, sum(octet_length(encode(text)))::BIGINT AS total_bytes, count(*) AS frames,
 quantile_cont(octet_length(encode(text)), 0.5) AS median_bytes FROM documents GROUP BY source""",
)
def encoded_sizes(spark, folder):
    rows = read(spark, folder, "documents").select("source", F.octet_length("text").cast("bigint").alias("size"))
    return images.encoded_sizes(rows, ["source"], "size", bound=row_count(spark, folder, "documents"))


@query("value_counters", "SELECT source, lang, count(*) AS rows FROM documents GROUP BY ALL")
def value_counters(spark, folder):
    return images.value_counts(read(spark, folder, "documents"), ["source"], "lang")


@query(
    "sample_summary",
    """SELECT event_type AS topic, round(min(value), 6) AS value_min, round(avg(value), 6) AS value_mean, round(max(value), 6) AS value_max FROM events GROUP BY event_type""",
)
def sample_summary(spark, folder):
    rows = read(spark, folder, "events").withColumnRenamed("event_type", "topic")
    return settle(images.sample_summary(rows, ["topic"], ["value"]))


# --- value ranges ---

@query(
    "range_check",
    """SELECT l_returnflag AS topic, min(l_quantity) AS low, max(l_quantity) AS high, min(l_quantity) < -0.05 OR max(l_quantity) > 50 + 0.05 AS outside FROM lineitem GROUP BY l_returnflag""",
)
def range_check(spark, folder):
    return conversion.gripper_range(read(spark, folder, "lineitem").withColumnRenamed("l_returnflag", "topic"), ["topic"], "l_quantity", 50.0)


@query(
    "clip_normalise",
    """SELECT l_orderkey, l_linenumber, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, l_quantity / 40.0::DOUBLE)), 6) AS grip FROM lineitem""",
)
def clip_normalise(spark, folder):
    rows = read(spark, folder, "lineitem")
    return settle(rows.select("l_orderkey", "l_linenumber", clip(F.col("l_quantity") / 40.0, 0.0, 1.0).alias("grip")))


@query(
    "converted_vectors",
    f"WITH {ROBOT_SQL} SELECT episode, frame, dimension, round(state, 4) AS state, round(action, 4) AS action FROM robot",
)
def converted_vectors(spark, folder):
    frames = robot_frames(spark, folder).rows()
    both = frames.select("episode", "frame", F.posexplode(F.arrays_zip("state", "action")).alias("dimension", "_v"))
    return settle(both.select("episode", "frame", "dimension", "_v.state", "_v.action"), 4)


_STATE = ("click", "error")
_ACTION = ("purchase", "signup")
_GROUPS = {"state": _STATE, "action": _ACTION, "image": ("view",)}


@query(
    "combined_residual",
    f"""{streams._GRID_SQL}, c AS (SELECT episode, target_index, CASE WHEN topic IN ('click', 'error') THEN 'state' WHEN topic IN ('purchase', 'signup') THEN 'action' WHEN topic = 'view' THEN 'image' END AS grp, max(abs(residual_ms)) AS r FROM mapped GROUP BY ALL)
 SELECT grp AS stream_group, round(quantile_cont(r, 0.5), 6) AS median_abs_ms, round(quantile_cont(r, 0.95), 6) AS p95_abs_ms, round(max(r), 6) AS max_abs_ms FROM c WHERE grp IS NOT NULL GROUP BY grp""",
)
def combined_residual(spark, folder):
    combined = conversion.combined_residuals(streams.mappings(spark, folder), ["episode"], _GROUPS)
    return settle(conversion.residual_report(combined, ["stream_group"], bound=streams.target_bound(spark, folder)))


@query(
    "residual_gate",
    f"""{streams._GRID_SQL}, c AS (SELECT episode, target_index, CASE WHEN topic IN ('click', 'error') THEN 'state' WHEN topic IN ('purchase', 'signup') THEN 'action' WHEN topic = 'view' THEN 'image' END AS grp, max(abs(residual_ms)) AS r FROM mapped GROUP BY ALL)
 SELECT grp AS stream_group, round(max(r), 6) AS max_abs_ms FROM c WHERE grp IS NOT NULL GROUP BY episode, grp HAVING max(r) > CASE grp WHEN 'state' THEN 1000000.0 WHEN 'action' THEN 100000000.0 ELSE 500000.0 END""",
)
def residual_gate(spark, folder):
    combined = conversion.combined_residuals(streams.mappings(spark, folder), ["episode"], _GROUPS)
    rejected = conversion.residual_gate(combined, ["episode"], {"state": 1_000_000.0, "action": 100_000_000.0, "image": 500_000.0})
    return settle(rejected.drop("episode"))


@query(
    "aligned_frames",
    f"""{streams._GRID_SQL} SELECT target_index, {", ".join(f"max(s.value) FILTER (m.topic = '{t}') AS {t}_value" for t in streams.TOPICS)} FROM mapped m
 JOIN stream s ON m.topic = s.topic AND m.source_index = s.topic_index GROUP BY m.episode, target_index""",
)
def aligned_frames(spark, folder):
    """Values of all streams side by side at every target: the frame assembly."""
    from telemark.operators.align import align_to_grid, common_spans, integer_grid

    line = streams._episodes(spark, folder)
    spans = integer_grid(common_spans(line.df, ["episode"], "topic", "time_ns"), streams.FPS)
    rows = align_to_grid(line, spans, ["episode"], "time_ns", {"source_index": F.col("topic_index"), "value": F.col("value")})
    return conversion.side_by_side(rows, ["episode"], {f"{t}_value": t for t in streams.TOPICS}, "value").drop("episode")


# --- labels and risks ---

@query(
    "annotation_override",
    """SELECT d.doc_id AS episode, coalesce(l.toxic = 0, true) AS include, CASE WHEN l.doc_id IS NULL THEN 'sort the parts' ELSE 'task ' || l.quality END AS task,
 CASE WHEN l.doc_id IS NULL THEN 0.0 ELSE l.quality * 1.5 END::DOUBLE AS start_time_s, l.quality = 1 AS success FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def annotation_override(spark, folder):
    return _annotated(spark, folder)


def _annotated(spark, folder):
    episodes = read(spark, folder, "documents").select(F.col("doc_id").alias("episode"))
    overrides = read(spark, folder, "labels").select(
        F.col("doc_id").alias("episode"),
        (F.col("toxic") == 0).alias("include"),
        F.concat(F.lit("task "), F.col("quality").cast("string")).alias("task"),
        (F.col("quality") * 1.5).alias("start_time_s"),
        (F.col("quality") == 1).alias("success"),
    )
    return quality.annotated(episodes, overrides, {"include": True, "task": "sort the parts", "start_time_s": 0.0})


@query(
    "included_episodes",
    "SELECT d.doc_id AS episode FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(l.toxic = 0, true)",
)
def included_episodes(spark, folder):
    return _annotated(spark, folder).filter("include").select("episode")


@query(
    "label_risks",
    """SELECT d.doc_id AS episode, CASE WHEN l.doc_id IS NULL THEN 'success_label_unverified' WHEN l.quality = 1 THEN 'success_label_verified' ELSE 'demonstration_failed' END AS risk_id,
 CASE WHEN l.doc_id IS NULL THEN 'warning' WHEN l.quality = 1 THEN 'pass' ELSE 'fail' END AS status, CASE WHEN l.quality = 0 THEN 'high' ELSE 'medium' END AS severity
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def label_risks(spark, folder):
    risks = quality.apply_rules(_annotated(spark, folder), ["episode"], quality.label_rules(), F.lit("labels"))
    return risks.select("episode", "risk_id", "status", "severity")


_CLOCK_SQL = f"""WITH {MESSAGES_SQL}, m AS (SELECT topic, max(dt_ms) AS dt_max, count(*) FILTER (dt_ms <= 0) AS nonpositive FROM edges GROUP BY topic),
r AS (SELECT topic, 'numeric_timestamp_nonpositive' AS risk_id, 'fail' AS status, 'high' AS severity FROM m WHERE nonpositive > 0
 UNION ALL SELECT topic, 'numeric_timestamp_gap', 'warning', 'medium' FROM m WHERE dt_max > 7200000)"""


def _clock_risks(spark, folder):
    from telemark.operators.timeline import series_stats

    clock = series_stats(stream(spark, folder, numbered=False), "time_ns")
    metrics = clock.withColumns({"nan_count": F.lit(0), "inf_count": F.lit(0)})
    return quality.apply_rules(metrics, ["topic"], quality.numeric_rules(F.lit(7_200_000.0)), F.col("topic"))


@query("clock_risks", f"{_CLOCK_SQL} SELECT * FROM r")
def clock_risks(spark, folder):
    return _clock_risks(spark, folder).select("topic", "risk_id", "status", "severity")


@query(
    "camera_risks",
    f"""WITH {MESSAGES_SQL}, m AS (SELECT topic, max(dt_ms) AS dt_max, count(*) FILTER (dt_ms <= 0) AS nonpositive FROM edges GROUP BY topic)
 SELECT topic, 'camera_timestamp_nonpositive' AS risk_id, 'warning' AS status, CASE WHEN topic = 'click' THEN 'high' ELSE 'medium' END AS severity FROM m WHERE nonpositive > 0
 UNION ALL SELECT topic, 'camera_timestamp_gap', 'warning', 'medium' FROM m WHERE dt_max > 7200000""",
)
def camera_risks(spark, folder):
    from telemark.operators.timeline import series_stats

    clock = series_stats(stream(spark, folder, numbered=False), "time_ns")
    metrics = clock.withColumns({"decode_failures": F.lit(0), "shapes": F.lit(1)})
    rules = quality.camera_rules(7_200_000.0, F.col("topic") == "click")
    return quality.apply_rules(metrics, ["topic"], rules, F.col("topic")).select("topic", "risk_id", "status", "severity")


@query(
    "motion_risks",
    f"""WITH {ROBOT_SQL}, st AS (SELECT episode, dimension, frame, degrees(abs(action - state)::DOUBLE) AS err, degrees(abs(action - lag(action) OVER (PARTITION BY episode, dimension ORDER BY frame))::DOUBLE) AS s FROM robot WHERE dimension < 14),
 w AS (SELECT episode, max(p) AS worst FROM (SELECT episode, dimension, quantile_cont(err, 0.95) AS p FROM st GROUP BY ALL) GROUP BY episode),
 j AS (SELECT episode, count(*) AS jumps FROM (SELECT episode, frame FROM st GROUP BY ALL HAVING max(s) > 40) GROUP BY episode)
 SELECT episode, 'action_discontinuity' AS risk_id, CASE WHEN jumps > 0 THEN 'warning' ELSE 'pass' END AS status, 'high' AS severity FROM w LEFT JOIN j USING (episode)
 UNION ALL SELECT episode, 'leader_follower_tracking', CASE WHEN worst <= 1.6 THEN 'pass' ELSE 'warning' END, 'medium' FROM w""",
)
def motion_risks(spark, folder):
    return _motion_risks(spark, folder).select("episode", "risk_id", "status", "severity")


def _motion_risks(spark, folder):
    jumps = quality.action_quality(joints._steps(spark, folder), ["episode"], 40.0)
    bound = row_count(spark, folder, "embeddings") * 14
    tracking = quality.tracking_totals(joints._tracking(spark, folder), ["episode"], bound=bound)
    return quality.apply_rules(jumps.join(tracking, "episode"), ["episode"], quality.motion_rules(1.6), F.lit("arm"))


@query(
    "residual_risks",
    f"""{streams._GRID_SQL} SELECT topic, 'image_alignment_residual' AS risk_id, CASE WHEN max(abs(residual_ms)) <= 3600000 THEN 'pass' ELSE 'fail' END AS status, 'high' AS severity FROM mapped GROUP BY topic""",
)
def residual_risks(spark, folder):
    worst = streams.mappings(spark, folder).groupBy("topic").agg(F.max(F.abs("residual_ms")).alias("max_abs_ms"))
    rule = quality.residual_rule("image_alignment_residual", 3_600_000.0)
    return quality.apply_rules(worst, ["topic"], [rule], F.col("topic")).select("topic", "risk_id", "status", "severity")


_LABEL_ROLL = """WITH r AS (SELECT d.doc_id AS episode, d.source, CASE WHEN l.doc_id IS NULL THEN 'warning' WHEN l.quality = 1 THEN 'pass' ELSE 'fail' END AS status,
 CASE WHEN l.quality = 0 THEN 'high' ELSE 'medium' END AS severity FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
 e AS (SELECT episode, count(*) FILTER (status = 'fail' AND severity = 'high') AS high_failures, count(*) FILTER (status = 'warning') AS warnings, count(*) AS items FROM r GROUP BY episode),
 v AS (SELECT *, CASE WHEN high_failures > 0 THEN 'fail' WHEN warnings > 0 THEN 'warning' ELSE 'pass' END AS overall_status FROM e)"""


@query("risk_rollup", f"{_LABEL_ROLL} SELECT * FROM v")
def risk_rollup(spark, folder):
    risks = quality.apply_rules(_annotated(spark, folder), ["episode"], quality.label_rules(), F.lit("labels"))
    return quality.roll_up(risks, ["episode"])


@query(
    "run_status",
    f"""{_LABEL_ROLL} SELECT count(*) FILTER (overall_status = 'fail') AS fail_episodes, count(*) FILTER (overall_status = 'warning') AS warning_episodes, count(*) FILTER (overall_status = 'pass') AS pass_episodes,
 CASE WHEN count(*) FILTER (overall_status = 'fail') > 0 THEN 'fail' WHEN count(*) FILTER (overall_status = 'warning') > 0 THEN 'warning' ELSE 'pass' END AS overall_status FROM v""",
)
def run_status(spark, folder):
    return quality.run_status(risk_rollup(spark, folder))


# --- detections ---

@query(
    "label_counts",
    """SELECT p.p_brand AS label, count(*) AS detections, count(DISTINCT l_orderkey) AS frames_with_label FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l_discount >= 0.02 GROUP BY p_brand""",
)
def label_counts(spark, folder):
    """Order lines as detections: the order is the frame, the brand the label."""
    return detection.label_counts(_detections(spark, folder), ["frame_index"]).select("label", "detections", "frames_with_label")


def _detections(spark, folder):
    found = read(spark, folder, "lineitem").join(read(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    boxes = found.select(
        F.col("l_orderkey").alias("frame_index"),
        F.col("p_brand").alias("label"),
        (F.col("l_discount") * 10).alias("confidence"),
        F.array("l_quantity", "l_tax").alias("bbox_xyxy"),
    )
    return detection.above_confidence(boxes, 0.2)


@query(
    "detection_summary",
    """SELECT count(DISTINCT l_orderkey) AS frames, count(DISTINCT l_orderkey) FILTER (l_discount >= 0.02) AS frames_with_detections, count(*) FILTER (l_discount >= 0.02) AS detections FROM lineitem""",
)
def detection_summary(spark, folder):
    frames = read(spark, folder, "lineitem").select(F.col("l_orderkey").alias("frame_index")).distinct()
    return detection.summary(frames, _detections(spark, folder), ["frame_index"])


# --- recordings, structure, plot data, decoded pictures ---

_WIRE = ["topic", "record_index", "topic_index", "sequence", "log_time_ns", "publish_time_ns", "body"]


@query(
    "recording_roundtrip",
    """WITH m AS (SELECT 'episode_' || (user_id % 4) AS episode, '/' || event_type AS topic, event_id, epoch_us(ts) * 1000 AS t, props FROM events)
 SELECT episode, topic, row_number() OVER (PARTITION BY episode ORDER BY event_id) - 1 AS record_index, row_number() OVER (PARTITION BY episode, topic ORDER BY event_id) - 1 AS topic_index,
 event_id AS sequence, t + event_id % 7 AS log_time_ns, t AS publish_time_ns, props AS body FROM m""",
)
def recording_roundtrip(spark, folder):
    """Events written as recordings (several files per episode) and read back."""
    from telemark.sources import mcap

    back = mcap.messages(mcap.scan(spark, _event_recordings(spark, folder), split_bytes=128 << 10))
    place = ["source_file", "cdr_file_offset", "cdr_size"]
    full = mcap.fetch(back.select("episode", *_WIRE[:-1], *place), *place)
    return full.withColumn("body", F.decode("data", "utf-8")).select("episode", *_WIRE)


def _event_recordings(spark, folder):
    """The folder of the events as recordings of four episodes."""
    from telemark.sources import mcap_sink
    from telemark.sources.durable import scratch

    events = read(spark, folder, "events").filter(F.col("event_id").isNotNull())
    rows = events.withColumns({"pub_ns": stamp_ns("ts"), "record_index": F.col("event_id")}).select(
        F.concat(F.lit("episode_"), (F.col("user_id") % 4).cast("string")).alias("episode"),
        F.col("record_index").alias("position"),
        F.concat(F.lit("/"), F.col("event_type")).alias("topic"),
        F.lit("event").alias("schema_name"),
        F.lit("jsonschema").alias("schema_encoding"),
        F.encode(F.lit('{"type":"object"}'), "utf-8").alias("schema_data"),
        F.lit("json").alias("message_encoding"),
        F.create_map(F.lit("source"), F.lit("events")).alias("channel_metadata"),
        F.col("record_index").alias("sequence"),
        (F.col("pub_ns") + F.col("record_index") % 7).alias("log_time_ns"),
        F.col("pub_ns").alias("publish_time_ns"),
        F.encode("props", "utf-8").alias("data"),
    )
    target = scratch(spark, "recordings")
    mcap_sink.write_recordings(rows, target, chunk_bytes=64 << 10, file_rows=4096)
    return target


_FILTERED_TOPICS = ("/click", "/error")
_FILTERED_NS = (1_704_500_000_000_000_000, 1_705_500_000_000_000_000)


@query(
    "recording_filtered",
    f"""WITH m AS (SELECT 'episode_' || (user_id % 4) AS episode, '/' || event_type AS topic, event_id, epoch_us(ts) * 1000 AS t FROM events),
 n AS (SELECT episode, topic, row_number() OVER (PARTITION BY episode ORDER BY event_id) - 1 AS record_index, event_id AS sequence, t + event_id % 7 AS log_time_ns, t AS publish_time_ns FROM m)
 SELECT * FROM n WHERE topic IN {_FILTERED_TOPICS} AND log_time_ns BETWEEN {_FILTERED_NS[0]} AND {_FILTERED_NS[1]}""",
)
def recording_filtered(spark, folder):
    """Two topics and a span of time, read through a chunk index; record numbers are those of the whole episode."""
    from telemark.sources import chunk_index

    root = _event_recordings(spark, folder)
    rows = chunk_index.scan(spark, root, chunk_index.build(spark, root, split_bytes=128 << 10))
    wanted = F.col("topic").isin(*_FILTERED_TOPICS) & F.col("log_time_ns").between(*_FILTERED_NS)
    return rows.filter(wanted).select("episode", "topic", "record_index", "sequence", "log_time_ns", "publish_time_ns")


@query(
    "structural_audit",
    """WITH m AS (SELECT label AS episode, 'joints' AS topic, vec_id, vec_id % 97 = 3 AS undecodable, vec_id % 89 = 50 AS renamed, vec_id % 83 = 7 AS no_header, vec_id % 79 = 9 AS broken FROM embeddings),
 c AS (SELECT episode, topic, count(*) AS sample_count, count(*) FILTER (undecodable) AS undecodable, count(*) FILTER (renamed) AS name_order_changes,
 count(*) FILTER (no_header) AS missing_headers, count(*) FILTER (broken AND NOT undecodable) AS nonfinite_values FROM m GROUP BY ALL)
 SELECT *, CASE WHEN undecodable + name_order_changes + missing_headers + nonfinite_values > 0 OR sample_count < 3 THEN 'invalid' ELSE 'valid' END AS structural_status FROM c""",
)
def structural_audit(spark, folder):
    """Joint messages with undecodable, renamed, unstamped and non-finite samples."""
    from telemark.operators import motion
    from telemark.plans.tables import joint_frames

    names = [f"joint_{i}" for i in range(1, 65)]
    key = F.col("vec_id")
    plain = F.col("vector")
    values = F.when(key % 79 == 9, F.transform(plain, lambda x, i: F.when(i == 0, float("inf")).otherwise(x))).otherwise(plain)
    rows = joint_frames(spark, folder).rows().select(
        "episode",
        F.lit("joints").alias("topic"),
        F.col("frame").alias("topic_index"),
        F.when(key % 89 == 50, F.reverse(F.array(*map(F.lit, names)))).otherwise(F.array(*map(F.lit, names))).alias("names"),
        F.when(key % 97 != 3, values).alias("values"),
        F.when(key % 83 != 7, F.col("time_ns")).alias("header_time_ns"),
    )
    audit = motion.structural_audit(rows, ["episode", "topic"], {"joints": names})
    return audit.select(
        "episode", "topic", "sample_count", "undecodable", "name_order_changes", "missing_headers",
        F.coalesce("nonfinite_values", F.lit(0)).alias("nonfinite_values"), "structural_status",
    )


@query(
    "value_histogram",
    """WITH e AS (SELECT event_type AS topic, min(value) AS lo, (max(value) - min(value)) / 60 AS w FROM events GROUP BY event_type),
 b AS (SELECT topic, least(floor((value - lo) / w), 59)::BIGINT AS bin, lo, w FROM events JOIN e ON topic = event_type)
 SELECT topic, bin, round(min(lo + bin * w), 6) AS bin_start, count(*) AS rows FROM b GROUP BY topic, bin""",
)
def value_histogram(spark, folder):
    from telemark.sources.reports import histogram

    rows = read(spark, folder, "events").withColumnRenamed("event_type", "topic")
    return settle(histogram(rows, ["topic"], F.col("value")))


_BYTES_SQL = """WITH s AS (SELECT vec_id, p, c, greatest(0, least(255, round_even((embedding[least(p * 3 + c, 63) + 1]::DOUBLE * 1.2::DOUBLE + 0.8::DOUBLE) * 255, 0)))::INT AS code FROM embeddings, generate_series(0, 21) g(p), generate_series(0, 2) h(c)),
 y AS (SELECT vec_id, p, c, code, CASE WHEN code / 255.0::DOUBLE <= 0.04045::DOUBLE THEN code / 255.0::DOUBLE / 12.92::DOUBLE ELSE pow((code / 255.0::DOUBLE + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) END AS lin FROM s),
 px AS (SELECT vec_id, p, sum(CASE c WHEN 0 THEN 0.0722::DOUBLE WHEN 1 THEN 0.7152::DOUBLE ELSE 0.2126::DOUBLE END * lin) AS light,
 round_even(sum(CASE c WHEN 0 THEN 0.114::DOUBLE WHEN 1 THEN 0.587::DOUBLE ELSE 0.299::DOUBLE END * code), 0) AS gray FROM y GROUP BY ALL)"""


def _decoded(spark, folder):
    """Pictures of 2 x 11 pixels, as blue-green-red bytes made of each vector; the last pixel repeats the last value."""
    code = F.transform(
        F.transform(F.sequence(F.lit(0), F.lit(65)), lambda i: F.get("embedding", F.least(i, F.lit(63))).cast("double")),
        lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.rint((x * 1.2 + 0.8) * 255).cast("int"))),
    )
    data = F.unhex(F.array_join(F.transform(code, lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    shape = [F.lit(2).alias("height"), F.lit(11).alias("width"), F.lit(3).alias("nChannels")]
    return read(spark, folder, "embeddings").select("vec_id", F.struct(*shape, data.alias("data")).alias("image"))


@query(
    "picture_luminance",
    f"""{_BYTES_SQL} SELECT vec_id, round(quantile_cont(light, 0.5), 3) AS l50, round(quantile_cont(light, 0.95), 3) AS l95, round(count(*) FILTER (light > 0.98) / count(*)::DOUBLE, 3) AS highlight_clipping_ratio FROM px GROUP BY vec_id""",
)
def picture_luminance(spark, folder):
    return settle(exposure.image_luminance_metrics(_decoded(spark, folder), "image", EXPOSURE).drop("image"), 3)


@query(
    "picture_samples",
    f"""{_BYTES_SQL} SELECT vec_id, round(avg(gray), 4) AS brightness_mean, round(count(*) FILTER (gray < 10) / count(*)::DOUBLE, 4) AS dark_pixel_ratio, round(count(*) FILTER (gray > 245) / count(*)::DOUBLE, 4) AS bright_pixel_ratio FROM px GROUP BY vec_id""",
)
def picture_samples(spark, folder):
    return settle(images.sample_metrics(_decoded(spark, folder)).drop("image", "laplacian_variance"), 4)
