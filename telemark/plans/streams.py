"""Queries on message streams: clocks, gaps, alignment, repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemark.config import HeadTimestamp
from telemark.functions.quantile import summarise
from telemark.functions.scalar import safe_name, slug, split_time, to_ms, to_seconds, topic_category
from telemark.functions.sequence import Track, carry, kept
from telemark.operators import align, repair, resample, timeline
from telemark.operators.motion import audit_gaps
from telemark.operators.images import value_counts
from telemark.plans.registry import Registry
from telemark.plans.tables import (
    CAMERA_SQL,
    FRAME_NS,
    MESSAGES_SQL,
    camera,
    messages,
    read,
    row_count,
    settle,
    stream,
)

FPS = 1 / 120
THRESHOLDS_MS = (10_000.0, 60_000.0, 600_000.0)
_registry = Registry()
query, QUERIES, ORACLES = _registry.query, _registry.queries, _registry.oracles


def _bound(spark, folder):
    return row_count(spark, folder, "events")


DISTRIBUTION_SQL = """round(min({0}), 6) AS {1}min, round(avg({0}), 6) AS {1}mean, round(quantile_cont({0}, 0.5), 6) AS {1}median,
 round(quantile_cont({0}, 0.95), 6) AS {1}p95, round(quantile_cont({0}, 0.99), 6) AS {1}p99, round(max({0}), 6) AS {1}max,
 round(stddev_pop({0}), 6) AS {1}std"""


# --- clocks and gaps ---

@query("primary_time", f"WITH {MESSAGES_SQL} SELECT topic, record_index, time_ns FROM stream")
def primary_time_query(spark, folder):
    return stream(spark, folder, numbered=False).rows().select("topic", "record_index", "time_ns")


@query("message_numbering", f"WITH {MESSAGES_SQL} SELECT topic, record_index, topic_index FROM stream")
def message_numbering(spark, folder):
    return stream(spark, folder).rows().select("topic", "record_index", "topic_index")


@query(
    "relative_time",
    f"""WITH {MESSAGES_SQL} SELECT topic, record_index,
 (pub_ns - first_value(pub_ns) OVER (PARTITION BY topic ORDER BY record_index)) / 1e9 AS relative_s FROM stream""",
)
def relative_time(spark, folder):
    line = stream(spark, folder, "pub_ns", numbered=False)
    first = line.df.groupBy("topic").agg(F.min_by("pub_ns", "record_index").alias("_first"))
    rows = line.df.join(first, "topic")
    return rows.select("topic", "record_index", to_seconds(F.col("pub_ns") - F.col("_first")).alias("relative_s"))


@query(
    "time_split",
    f"WITH {MESSAGES_SQL} SELECT record_index, time_ns // 1000000000 AS seconds, time_ns % 1000000000 AS nanos FROM stream",
)
def time_split(spark, folder):
    seconds, nanos = split_time(F.col("time_ns"))
    return stream(spark, folder, numbered=False).rows().select("record_index", seconds.alias("seconds"), nanos.alias("nanos"))


@query("topic_counts", "SELECT event_type AS topic, count(*) AS messages FROM events GROUP BY ALL")
def topic_counts(spark, folder):
    return messages(spark, folder).groupBy("topic").agg(F.count("*").alias("messages"))


@query(
    "topic_names",
    """SELECT p_name AS name, coalesce(nullif(lower(trim(regexp_replace(p_name, '[^a-zA-Z0-9]+', '_', 'g'), '_')), ''), 'stream') AS slug,
 trim(regexp_replace(p_name, '[^A-Za-z0-9_-]+', '_', 'g'), '_') AS safe, count(*) AS parts FROM part GROUP BY ALL""",
)
def topic_names(spark, folder):
    names = read(spark, folder, "part").groupBy(F.col("p_name").alias("name")).agg(F.count("*").alias("parts"))
    return names.select("name", slug(F.col("name")).alias("slug"), safe_name(F.col("name")).alias("safe"), "parts")


_AS_TOPIC = {"click": "/camera/head/color/image_raw/compressed", "view": "/lead/joint_states", "purchase": "/hal/joint_states"}


@query(
    "topic_category",
    f"""WITH {MESSAGES_SQL} SELECT topic, count(*) AS messages,
 CASE topic WHEN 'click' THEN 'image' WHEN 'view' THEN 'action' ELSE 'state' END AS category,
 CASE WHEN count(header_time_ns) = count(*) THEN 'header' ELSE 'publish_or_log' END AS time_source FROM stream GROUP BY topic""",
)
def topic_category_query(spark, folder):
    renamed = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in _AS_TOPIC.items() for x in kv]), F.col("topic")), F.col("topic"))
    rows = messages(spark, folder).groupBy("topic").agg(
        F.count("*").alias("messages"),
        F.when(F.count("header_time_ns") == F.count("*"), "header").otherwise("publish_or_log").alias("time_source"),
    )
    return rows.select("topic", "messages", topic_category(renamed).alias("category"), "time_source")


@query(
    "header_series_gate",
    f"""WITH {MESSAGES_SQL} SELECT topic, count(*) AS samples, count(header_time_ns) = count(*) AS complete_headers,
 count(*) FILTER (header_time_ns IS NULL) AS missing_headers FROM stream GROUP BY topic""",
)
def header_series_gate(spark, folder):
    return messages(spark, folder).groupBy("topic").agg(
        F.count("*").alias("samples"),
        (F.count("header_time_ns") == F.count("*")).alias("complete_headers"),
        F.count_if(F.col("header_time_ns").isNull()).alias("missing_headers"),
    )


_RATE_SQL = """count(*) AS count, (max_by(time_ns, record_index) - min_by(time_ns, record_index)) / 1e9 AS duration_s,
 round((count(*) - 1) / ((max_by(time_ns, record_index) - min_by(time_ns, record_index)) / 1e9), 6) AS effective_hz"""


@query(
    "timestamp_metrics",
    f"""WITH {MESSAGES_SQL} SELECT topic, {_RATE_SQL}, {DISTRIBUTION_SQL.format('dt_ms', 'dt_')},
 count(*) FILTER (dt_ms <= 0) AS nonpositive FROM edges GROUP BY topic""",
)
def timestamp_metrics(spark, folder):
    return settle(timeline.timestamp_metrics(stream(spark, folder, numbered=False), "time_ns"))


@query(
    "series_stats",
    f"""WITH {MESSAGES_SQL} SELECT topic, {_RATE_SQL}, round(quantile_cont(dt_ms, 0.5), 6) AS dt_median,
 round(quantile_cont(dt_ms, 0.95), 6) AS dt_p95, round(max(dt_ms), 6) AS dt_max, count(*) FILTER (dt_ms <= 0) AS nonpositive
 FROM edges GROUP BY topic""",
)
def series_stats(spark, folder):
    return settle(timeline.series_stats(stream(spark, folder, numbered=False), "time_ns"))


# Sorting by time first turns backward steps into positive ones: only duplicates stay.
@query(
    "sorted_series_stats",
    f"""WITH {MESSAGES_SQL}, so AS (SELECT topic, time_ns, (time_ns - lag(time_ns) OVER (PARTITION BY topic ORDER BY time_ns, record_index)) / 1e6 AS dt_ms FROM stream)
 SELECT topic, count(*) AS count, round((max(time_ns) - min(time_ns)) / 1e9, 6) AS duration_s,
 round((count(*) - 1) / ((max(time_ns) - min(time_ns)) / 1e9), 6) AS effective_hz, round(quantile_cont(dt_ms, 0.5), 6) AS dt_median,
 round(quantile_cont(dt_ms, 0.95), 6) AS dt_p95, round(max(dt_ms), 6) AS dt_max, count(*) FILTER (dt_ms <= 0) AS nonpositive
 FROM so GROUP BY topic""",
)
def sorted_series_stats(spark, folder):
    return settle(timeline.series_stats(sorted_stream(spark, folder), "time_ns"))


def sorted_stream(spark, folder) -> Track:
    from telemark.functions.sequence import track

    rows = stream(spark, folder, numbered=False).rows()
    return track(rows, ["topic"], ["time_ns", "record_index"], bound=_bound(spark, folder))


_PACE_SQL = f"""WITH {MESSAGES_SQL}, pace AS (SELECT topic, quantile_cont(dt_ms, 0.5) FILTER (dt_ms > 0.05) AS nominal FROM edges GROUP BY topic),
paced AS (SELECT e.*, nominal, dt_ms / nominal AS multiple FROM edges e JOIN pace USING (topic) WHERE dt_ms IS NOT NULL)"""


@query(
    "gap_statistics",
    f"""{_PACE_SQL}, ends AS (SELECT topic, {_RATE_SQL} FROM stream GROUP BY topic),
 counted AS (SELECT topic, round(first(nominal), 6) AS nominal_period_ms, round(first(nominal) * 2.2, 6) AS gap_warning_ms,
 round(first(nominal) * 5.0, 6) AS gap_fail_ms, {DISTRIBUTION_SQL.format('dt_ms', 'dt_')},
 count(*) FILTER (dt_ms < -0.05) AS negative_count, count(*) FILTER (dt_ms <= 0.05) AS nonpositive_count,
 count(*) FILTER (abs(dt_ms) <= 0.05) AS duplicate_count, count(*) FILTER (dt_ms > nominal * 2.2) AS warning_gap_count,
 count(*) FILTER (dt_ms > nominal * 5.0) AS fail_gap_count FROM paced GROUP BY topic)
 SELECT * FROM ends JOIN counted USING (topic)""",
)
def gap_statistics(spark, folder):
    return settle(timeline.gap_statistics(stream(spark, folder, numbered=False), "time_ns"))


@query(
    "period_multiples",
    f"""{_PACE_SQL} SELECT topic, CASE WHEN dt_ms <= 0.05 THEN 'nonpositive_or_duplicate'
 WHEN greatest(1, round_even(multiple, 0)) < 5 THEN greatest(1, round_even(multiple, 0))::BIGINT || 'T' ELSE '>=5T' END AS period_bucket,
 count(*) AS steps FROM paced GROUP BY ALL""",
)
def period_multiples(spark, folder):
    return timeline.period_multiples(stream(spark, folder, numbered=False), "time_ns")


@query(
    "gap_events",
    f"""{_PACE_SQL} SELECT topic, topic_index - 1 AS edge_after_source_index, round(dt_ms, 6) AS gap_ms, round(multiple, 6) AS period_multiple,
 CASE WHEN dt_ms > 5.0 * nominal THEN 'fail' WHEN dt_ms > 2.2 * nominal THEN 'warning' ELSE 'info' END AS severity
 FROM paced WHERE dt_ms > 1.5 * nominal""",
)
def gap_events(spark, folder):
    return settle(timeline.gap_events(stream(spark, folder), "time_ns", "topic_index"))


@query(
    "gap_events_both_timelines",
    f"""WITH {MESSAGES_SQL}, two AS (SELECT topic, topic_index, 'cleaned' AS timeline, (pub_ns - lag(pub_ns) OVER (PARTITION BY topic ORDER BY record_index)) / 1e6 AS dt_ms FROM stream
 UNION ALL SELECT topic, topic_index, 'original', dt_ms FROM edges),
 pace AS (SELECT topic, timeline, quantile_cont(dt_ms, 0.5) FILTER (dt_ms > 0.05) AS nominal FROM two GROUP BY ALL)
 SELECT topic, timeline, topic_index - 1 AS edge_after_source_index, round(dt_ms, 6) AS gap_ms, round(dt_ms / nominal, 6) AS period_multiple,
 CASE WHEN dt_ms > 5.0 * nominal THEN 'fail' WHEN dt_ms > 2.2 * nominal THEN 'warning' ELSE 'info' END AS severity
 FROM two JOIN pace USING (topic, timeline) WHERE dt_ms > 1.5 * nominal""",
)
def gap_events_both_timelines(spark, folder):
    parts = [
        timeline.gap_events(stream(spark, folder, column), "time_ns", "topic_index").withColumn("timeline", F.lit(name))
        for name, column in (("original", None), ("cleaned", "pub_ns"))
    ]
    return settle(parts[0].unionByName(parts[1]))


@query(
    "audit_gaps",
    f"""WITH {MESSAGES_SQL}, s AS (SELECT topic, (pub_ns - lag(pub_ns) OVER (PARTITION BY topic ORDER BY record_index)) / 1e9 * 1000 AS dt FROM stream),
 a AS (SELECT topic, count(*) AS samples, min(dt) AS mn, max(dt) AS mx, count(*) FILTER (dt <= 0) AS nonpositive_count,
 count(*) FILTER (dt <= 0.05) AS near_duplicate_count, quantile_cont(dt, 0.5) AS med, quantile_cont(dt, 0.95) AS p95 FROM s GROUP BY topic),
 l AS (SELECT *, greatest(CASE WHEN topic = 'view' THEN 600000.0 ELSE 1800000.0 END::DOUBLE, med * 2.2::DOUBLE) AS w,
 greatest(CASE WHEN topic = 'view' THEN 600000.0 ELSE 1800000.0 END::DOUBLE, med * 5.0::DOUBLE) AS f FROM a)
 SELECT l.topic, samples, round(mn, 6) AS min_dt_ms, round(mx, 6) AS max_dt_ms, nonpositive_count, near_duplicate_count, round(med, 6) AS median_dt_ms,
 round(p95, 6) AS p95_dt_ms, round(w, 6) AS gap_warning_ms, round(f, 6) AS gap_fail_ms,
 count(*) FILTER (dt > w) AS gap_count, count(*) FILTER (dt > f) AS severe_gap_count FROM l JOIN s USING (topic) GROUP BY ALL""",
)
def audit_gaps_query(spark, folder):
    floor = F.when(F.col("topic") == "view", 600_000.0).otherwise(1_800_000.0)
    return settle(audit_gaps(stream(spark, folder, "pub_ns"), "time_ns", "topic_index", floor))


# --- camera steps ---

def _judged(spark, folder):
    return timeline.judged_steps(camera(spark, folder), "header_ns", F.lit(FRAME_NS))


_JUDGED_SQL = f"""WITH {CAMERA_SQL}, j AS (SELECT topic, fr, step_ns, abs(step_ns - 33333000) AS deviation_ns,
 abs(step_ns - 33333000) <= 33333000 * 0.2::DOUBLE AS normal, step_ns / 33333000.0::DOUBLE AS multiple,
 round_even(step_ns / 33333000.0::DOUBLE, 0)::BIGINT AS rounded_multiple FROM cedge WHERE step_ns IS NOT NULL)"""


@query(
    "step_anomalies",
    f"""{_JUDGED_SQL} SELECT topic, count(*) FILTER (normal) AS normal_count, count(*) FILTER (NOT normal) AS anomaly_count,
 count(*) FILTER (step_ns = 0) AS duplicate_count, count(*) FILTER (step_ns < 0) AS negative_count FROM j GROUP BY topic""",
)
def step_anomalies(spark, folder):
    return timeline.step_anomalies(_judged(spark, folder), ["topic"])


@query(
    "anomaly_multiples",
    f"{_JUDGED_SQL} SELECT topic, rounded_multiple, count(*) AS steps FROM j WHERE NOT normal GROUP BY ALL",
)
def anomaly_multiples(spark, folder):
    return timeline.anomaly_multiples(_judged(spark, folder), ["topic"])


@query(
    "step_anomalies_top20",
    f"""{_JUDGED_SQL} SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY deviation_ns DESC, fr DESC) AS place,
 fr - 1 AS edge_after_frame, step_ns, round(multiple, 6) AS period_multiple FROM j WHERE NOT normal
 QUALIFY row_number() OVER (PARTITION BY topic ORDER BY deviation_ns DESC, fr DESC) <= 20""",
)
def step_anomalies_top20(spark, folder):
    odd = _judged(spark, folder).filter(~F.col("normal"))
    best = timeline.top_rows(odd, ["topic"], [F.col("deviation_ns").desc(), F.col("fr").desc()], 20)
    return settle(best.select("topic", "place", (F.col("fr") - 1).alias("edge_after_frame"), "step_ns", "period_multiple"))


# --- alignment ---

_GRID_SQL = f"""WITH {MESSAGES_SQL}, ends AS (SELECT episode, topic, min(pub_ns) AS f, max(pub_ns) AS l FROM stream GROUP BY ALL),
span AS (SELECT episode, max(f) AS s, min(l) AS e, min(f) AS origin FROM ends GROUP BY episode),
targets AS (SELECT episode, i AS target_index, s + i * 120000000000 AS t FROM span, generate_series(0, (e - s) // 120000000000) g(i)),
asked AS (SELECT episode, topic, target_index, t FROM targets JOIN (SELECT DISTINCT episode, topic FROM stream) USING (episode)),
lefts AS (SELECT a.*, b.pub_ns AS lt, b.topic_index AS li FROM asked a ASOF LEFT JOIN stream b ON a.episode = b.episode AND a.topic = b.topic AND a.t > b.pub_ns),
both_ AS (SELECT a.*, c.pub_ns AS rt, c.topic_index AS ri FROM lefts a ASOF LEFT JOIN stream c ON a.episode = c.episode AND a.topic = c.topic AND a.t <= c.pub_ns),
chosen AS (SELECT episode, topic, target_index, t, CASE WHEN rt IS NULL OR (lt IS NOT NULL AND t - lt <= rt - t) THEN li ELSE ri END AS source_index,
 CASE WHEN rt IS NULL OR (lt IS NOT NULL AND t - lt <= rt - t) THEN lt ELSE rt END AS src FROM both_),
mapped AS (SELECT *, src - t AS residual_ns, (src - t) / 1e6 AS residual_ms,
 coalesce(source_index = lag(source_index) OVER (PARTITION BY episode, topic ORDER BY target_index), false) AS reused FROM chosen)"""


def _episodes(spark, folder) -> Track:
    """Streams per episode; a recording is one calendar year of events."""
    line = stream(spark, folder, "pub_ns")
    return Track(line.df, ("episode", *line.keys), line.order, line.segments, line.looked, line.largest)


def target_bound(spark, folder) -> int:
    """Targets per stream, from the ends of the streams alone."""
    grid = align.integer_grid(_spans(spark, folder), FPS)
    return grid.agg(F.max("target_count")).first()[0] or 0


def mappings(spark, folder):
    """Target mapping whose original time is the raw header stamp."""
    line = _episodes(spark, folder).derive({"header_or_pub": F.coalesce("header_time_ns", "pub_ns")})
    return resample.target_mappings(line, ["episode"], FPS, "time_ns", "header_or_pub", "topic_index")


@query(
    "fixed_grid",
    f"{_GRID_SQL} SELECT target_index, t AS target_time_ns FROM targets",
)
def fixed_grid(spark, folder):
    spans = _spans(spark, folder)
    return align.grid_targets(align.integer_grid(spans, FPS), ["episode"]).select("target_index", "target_time_ns")


def _spans(spark, folder):
    rows = messages(spark, folder).select("episode", "topic", "pub_ns")
    return align.common_spans(rows, ["episode"], "topic", "pub_ns")


@query(
    "fixed_grid_float",
    f"""WITH {MESSAGES_SQL}, ends AS (SELECT episode, topic, min(pub_ns) AS f, max(pub_ns) AS l FROM stream GROUP BY ALL),
 span AS (SELECT max(f) AS s, min(l) AS e FROM ends GROUP BY episode)
 SELECT i AS target_index, round_even(s + i * (1e9 / 0.007::DOUBLE), 0)::BIGINT AS target_time_ns
 FROM span, generate_series(0, floor((e - s) / (1e9 / 0.007::DOUBLE))::BIGINT) g(i)""",
)
def fixed_grid_float(spark, folder):
    grid = align.rounded_grid(_spans(spark, folder), 0.007)
    return align.grid_targets(grid, ["episode"], fractional=True).select("target_index", "target_time_ns")


@query(
    "trimmed_grid",
    f"""WITH {MESSAGES_SQL}, ends AS (SELECT episode, topic, min(pub_ns) AS f, max(pub_ns) AS l FROM stream GROUP BY ALL),
 span AS (SELECT max(f) AS cs, min(l) AS ce, min(f) AS o FROM ends GROUP BY episode),
 cut AS (SELECT greatest(cs, o + 86400000000000) AS s, least(ce, o + 1728000000000000) AS e FROM span)
 SELECT s AS start_ns, e AS end_ns, floor((e - s) / (1e9 / 0.007::DOUBLE))::BIGINT + 1 AS target_count FROM cut WHERE e > s""",
)
def trimmed_grid(spark, folder):
    cut = align.trimmed_spans(_spans(spark, folder), F.lit(86_400.0), F.lit(1_728_000.0))
    return align.rounded_grid(cut, 0.007).select("start_ns", "end_ns", "target_count")


@query(
    "grid_alignment",
    f"""{_GRID_SQL} SELECT m.topic, m.target_index, t AS target_time_ns, source_index, src AS cleaned_time_ns,
 coalesce(header_time_ns, pub_ns) AS original_time_ns, residual_ns, residual_ms, (coalesce(header_time_ns, pub_ns) - t) / 1e6 AS raw_to_target_residual_ms,
 reused AS reused_previous_source FROM mapped m JOIN stream s ON m.topic = s.topic AND m.source_index = s.topic_index""",
)
def grid_alignment(spark, folder):
    return mappings(spark, folder).drop("episode")


@query(
    "asof_nearest",
    f"""WITH {MESSAGES_SQL}, span AS (SELECT min(pub_ns) AS f, max(pub_ns) AS l FROM stream),
 asked AS (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'purchase' WHEN 3 THEN 'signup' ELSE 'error' END AS topic,
 o_orderkey, f - 3600000000000 + (o_orderkey * 100000000003) % (l - f + 7200000000000) AS t FROM orders, span),
 lefts AS (SELECT a.*, b.pub_ns AS lt, b.topic_index AS li FROM asked a ASOF LEFT JOIN stream b ON a.topic = b.topic AND a.t > b.pub_ns),
 both_ AS (SELECT a.*, c.pub_ns AS rt, c.topic_index AS ri FROM lefts a ASOF LEFT JOIN stream c ON a.topic = c.topic AND a.t <= c.pub_ns)
 SELECT topic, o_orderkey, t AS probe_ns, CASE WHEN rt IS NULL OR (lt IS NOT NULL AND t - lt <= rt - t) THEN li ELSE ri END AS source_index,
 CASE WHEN rt IS NULL OR (lt IS NOT NULL AND t - lt <= rt - t) THEN lt ELSE rt END AS source_time_ns,
 CASE WHEN rt IS NULL OR (lt IS NOT NULL AND t - lt <= rt - t) THEN lt ELSE rt END - t AS residual_ns FROM both_""",
)
def asof_nearest(spark, folder):
    """Arbitrary probe times (one per order, some outside the recording) against all streams."""
    sources = stream(spark, folder, "pub_ns").rows().select("topic", "topic_index", F.col("time_ns").alias("source_time_ns"))
    first, last = messages(spark, folder).agg(F.min("pub_ns"), F.max("pub_ns")).first()
    hour = 3_600_000_000_000
    names = F.array(*[F.lit(n) for n in ("click", "view", "purchase", "signup", "error")])
    key = F.col("o_orderkey")
    at = (key * 100_000_000_003) % (last - first + 2 * hour) + (first - hour)
    probes = read(spark, folder, "orders").select(F.get(names, (key % 5).cast("int")).alias("topic"), key, at.alias("probe_ns"))
    total = _bound(spark, folder) + row_count(spark, folder, "orders")
    found = align.nearest_asof(
        probes, sources, ["topic"], "probe_ns", "source_time_ns", ["topic_index"], source_order="topic_index", bound=total
    )
    return found.withColumnRenamed("topic_index", "source_index")


@query(
    "asof_residual_stats",
    f"""{_GRID_SQL}, r AS (SELECT topic, residual_ms AS r, abs(residual_ms) AS a FROM mapped)
 SELECT topic, {DISTRIBUTION_SQL.format('r', 'signed_')}, {DISTRIBUTION_SQL.format('a', 'abs_')},
 count(*) FILTER (r < 0) AS past_source_count, count(*) FILTER (r = 0) AS exact_source_count, count(*) FILTER (r > 0) AS future_source_count
 FROM r GROUP BY topic""",
)
def asof_residual_stats(spark, folder):
    return settle(resample.residual_stats(mappings(spark, folder), ["topic"], F.col("residual_ms"), bound=target_bound(spark, folder)))


@query(
    "residual_summary",
    f"""{_GRID_SQL} SELECT topic, round(quantile_cont(abs(residual_ms), 0.5), 6) AS median_abs_ms, round(quantile_cont(abs(residual_ms), 0.95), 6) AS p95_abs_ms,
 round(max(abs(residual_ms)), 6) AS max_abs_ms FROM mapped GROUP BY topic""",
)
def residual_summary(spark, folder):
    size = F.abs("residual_ms")
    wanted = {"r": (size, {"median_abs_ms": 0.5, "p95_abs_ms": 0.95})}
    return settle(summarise(mappings(spark, folder), ["topic"], [F.max(size).alias("max_abs_ms")], wanted, bound=target_bound(spark, folder)))


@query(
    "threshold_exceedance",
    f"""{_GRID_SQL} SELECT topic, x AS threshold_ms, count(*) FILTER (abs(residual_ms) > x) AS exceeded,
 round(count(*) FILTER (abs(residual_ms) > x) / count(*)::DOUBLE, 6) AS ratio
 FROM mapped, (SELECT unnest([10000.0::DOUBLE, 60000.0::DOUBLE, 600000.0::DOUBLE]) AS x) GROUP BY ALL""",
)
def threshold_exceedance(spark, folder):
    return settle(resample.threshold_exceedance(mappings(spark, folder), ["topic"], F.col("residual_ms"), THRESHOLDS_MS))


@query(
    "mapping_counters",
    f"""{_GRID_SQL}, used AS (SELECT topic, count(*) AS target_count, count(DISTINCT source_index) AS selected_unique_count,
 count(*) FILTER (reused) AS reused_target_count FROM mapped GROUP BY topic),
 have AS (SELECT topic, count(*) AS source_count FROM stream GROUP BY topic)
 SELECT topic, source_count, target_count, selected_unique_count, reused_target_count, source_count - selected_unique_count AS omitted_source_count,
 round((source_count - selected_unique_count) / source_count::DOUBLE, 6) AS omitted_source_ratio,
 round(reused_target_count / target_count::DOUBLE, 6) AS reused_target_ratio FROM have JOIN used USING (topic)""",
)
def mapping_counters(spark, folder):
    return settle(resample.mapping_counters(mappings(spark, folder), messages(spark, folder), ["topic"]))


@query("unique_selection", f"{_GRID_SQL} SELECT DISTINCT topic, source_index FROM mapped")
def unique_selection(spark, folder):
    return resample.unique_selection(mappings(spark, folder), ["topic"])


@query(
    "unique_output_order",
    f"""{_GRID_SQL}, pick AS (SELECT DISTINCT topic, source_index FROM mapped)
 SELECT row_number() OVER (PARTITION BY s.topic ORDER BY log_time_ns, record_index) - 1 AS position, s.topic, record_index, log_time_ns
 FROM pick p JOIN stream s ON p.topic = s.topic AND p.source_index = s.topic_index""",
)
def unique_output_order(spark, folder):
    """Selected sources with their original envelope, ordered by log time and record."""
    from telemark.functions.sequence import track

    picked = resample.unique_selection(mappings(spark, folder), ["topic"]).withColumnRenamed("source_index", "topic_index")
    rows = stream(spark, folder, "pub_ns").rows().join(picked, ["topic", "topic_index"])
    line = track(rows, ["topic"], ["log_time_ns", "record_index"], bound=_bound(spark, folder))
    return carry(line, number="position").rows().select("position", "topic", "record_index", "log_time_ns")


TOPICS = ("click", "error", "purchase", "signup", "view")


@query(
    "pairwise_skew",
    f"""{_GRID_SQL}, pr AS (SELECT l.topic AS left_topic, r.topic AS right_topic, (l.src - r.src) / 1e6 AS s
 FROM mapped l JOIN mapped r ON l.episode = r.episode AND l.target_index = r.target_index AND l.topic < r.topic),
 x AS (SELECT *, abs(s) AS a FROM pr)
 SELECT left_topic, right_topic, {DISTRIBUTION_SQL.format('s', 'signed_')}, {DISTRIBUTION_SQL.format('a', 'abs_')},
 count(*) FILTER (s < 0) AS past_source_count, count(*) FILTER (s = 0) AS exact_source_count, count(*) FILTER (s > 0) AS future_source_count
 FROM x GROUP BY ALL""",
)
def pairwise_skew(spark, folder):
    pairs = resample.topic_pairs(mappings(spark, folder), ["episode"])
    return settle(resample.residual_stats(pairs, ["left_topic", "right_topic"], to_ms(F.col("skew_ns")), bound=target_bound(spark, folder)))


@query(
    "worst_pairs",
    f"""{_GRID_SQL}, pr AS (SELECT l.topic AS left_topic, r.topic AS right_topic, abs(l.src - r.src) / 1e6 AS a
 FROM mapped l JOIN mapped r ON l.episode = r.episode AND l.target_index = r.target_index AND l.topic < r.topic),
 q AS (SELECT left_topic, right_topic, round(quantile_cont(a, 0.95), 6) AS abs_p95_ms FROM pr GROUP BY ALL)
 SELECT row_number() OVER (ORDER BY abs_p95_ms DESC, left_topic, right_topic) AS place, * FROM q ORDER BY place LIMIT 5""",
)
def worst_pairs(spark, folder):
    pairs = resample.topic_pairs(mappings(spark, folder), ["episode"])
    size = F.abs(to_ms(F.col("skew_ns")))
    wanted = {"a": (size, {"abs_p95_ms": 0.95})}
    ranked = settle(summarise(pairs, ["left_topic", "right_topic"], [], wanted, bound=target_bound(spark, folder)))
    return timeline.top_rows(ranked, [], [F.col("abs_p95_ms").desc(), F.col("left_topic"), F.col("right_topic")], 5)


@query(
    "alignment_violations",
    f"""WITH {MESSAGES_SQL} SELECT topic, count(*) AS samples, count(*) FILTER (step_ns <= 0) AS nonincreasing,
 CASE WHEN count(*) < 2 THEN 'fewer than two samples' ELSE 'non-increasing timestamps' END AS reason
 FROM edges GROUP BY topic HAVING count(*) < 2 OR count(*) FILTER (step_ns <= 0) > 0""",
)
def alignment_violations(spark, folder):
    return resample.stream_violations(stream(spark, folder, numbered=False), "time_ns")


@query(
    "lineage_samples",
    f"""WITH {MESSAGES_SQL}, fix AS (SELECT record_index, header_time_ns AS raw, 'local_interpolation' AS method, 'warning' AS risk,
 round((pub_ns - header_time_ns) / 1e6, 3) AS shift FROM msg WHERE header_time_ns <> pub_ns)
 SELECT topic, topic_index AS source_index, s.record_index AS mcap_record_index,
 CASE WHEN f.record_index IS NOT NULL THEN raw ELSE s.pub_ns END AS original_primary_time_ns, s.pub_ns AS cleaned_primary_time_ns,
 coalesce(shift, 0.0) AS cleaning_correction_ms, coalesce(method, 'original') AS repair_method, coalesce(f.risk, 'none') AS risk
 FROM stream s LEFT JOIN fix f ON s.record_index = f.record_index""",
)
def lineage_samples(spark, folder):
    """Cleaned messages joined with the correction table by record index."""
    line = stream(spark, folder, "pub_ns").rows()
    cleaned = line.select(
        F.lit("all").alias("episode"),
        "topic",
        "topic_index",
        "record_index",
        F.lit("events").alias("source_file"),
        F.col("record_index").alias("sequence"),
        F.col("pub_ns").alias("header_time_ns"),
        "publish_time_ns",
        "log_time_ns",
    )
    fixes = messages(spark, folder).filter(F.col("header_time_ns") != F.col("pub_ns")).select(
        F.lit("all").alias("episode"),
        F.col("record_index").alias("mcap_record_index"),
        "header_time_ns",
        F.round(to_ms(F.col("pub_ns") - F.col("header_time_ns")), 3).alias("correction_ms"),
        F.lit("local_interpolation").alias("repair_method"),
        F.lit("warning").alias("risk"),
    )
    samples = resample.source_samples(cleaned, fixes)
    return samples.select(
        "topic",
        "source_index",
        "mcap_record_index",
        "original_primary_time_ns",
        "cleaned_primary_time_ns",
        "cleaning_correction_ms",
        "repair_method",
        "risk",
    )


@query(
    "missing_required_topics",
    """WITH need AS (SELECT DISTINCT user_id, t AS topic FROM events, (SELECT DISTINCT event_type AS t FROM events))
 SELECT n.user_id AS episode, n.topic FROM need n ANTI JOIN events e ON n.user_id = e.user_id AND n.topic = e.event_type""",
)
def missing_required_topics(spark, folder):
    """Episodes (users) that lack one of the required topics."""
    from telemark.sources.episodes import missing_topics

    seen = read(spark, folder, "events").select(F.col("user_id").alias("episode"), F.col("event_type").alias("topic"))
    return missing_topics(seen, ["episode"], TOPICS)


@query(
    "missing_topics_by_day",
    """WITH seen AS (SELECT DISTINCT user_id || ' ' || strftime(ts, '%Y-%m-%d') AS episode, event_type AS topic FROM events)
 SELECT e.episode, t.topic FROM (SELECT DISTINCT episode FROM seen) e, (SELECT DISTINCT topic FROM seen) t
 WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.episode = e.episode AND s.topic = t.topic)""",
)
def missing_topics_by_day(spark, folder):
    """Recordings of one user and day: most of them lack some required topic."""
    from telemark.sources.episodes import missing_topics

    return missing_topics(_daily(spark, folder), ["episode"], TOPICS)


def _daily(spark, folder):
    name = F.concat_ws(" ", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"))
    rows = read(spark, folder, "events")
    return rows.select(name.alias("episode"), F.col("event_type").alias("topic"), "event_id", "ts")


@query(
    "short_streams_by_day",
    """SELECT user_id || ' ' || strftime(ts, '%Y-%m-%d') AS episode, event_type AS topic, count(*) AS samples, 0 AS nonincreasing,
 'fewer than two samples' AS reason FROM events GROUP BY ALL HAVING count(*) < 2""",
)
def short_streams_by_day(spark, folder):
    """Streams of one user and day with a single sample: too short to align."""
    from telemark.functions.sequence import track

    rows = _daily(spark, folder).withColumn("time_ns", F.col("event_id"))
    return resample.stream_violations(track(rows, ["episode", "topic"], ["event_id"], bound=_bound(spark, folder)), "time_ns")


@query(
    "clean_alignment_ready",
    """SELECT user_id AS episode, event_type AS topic, count(*) AS samples, 'fewer than two samples' AS reason
 FROM events GROUP BY ALL HAVING count(*) < 2""",
)
def clean_alignment_ready(spark, folder):
    """Per user and topic: series too short to align."""
    from telemark.functions.sequence import track

    rows = read(spark, folder, "events").select(F.col("user_id").alias("episode"), F.col("event_type").alias("topic"), "event_id")
    line = track(rows, ["episode", "topic"], ["event_id"], bound=_bound(spark, folder))
    return resample.stream_violations(line, "event_id").drop("nonincreasing")


@query(
    "log_latency",
    f"""WITH {MESSAGES_SQL} SELECT topic, record_index, (log_time_ns - pub_ns) / 1e6 AS log_minus_publish_ms,
 (header_time_ns - pub_ns) / 1e6 AS header_minus_publish_ms FROM stream""",
)
def log_latency(spark, folder):
    return messages(spark, folder).select(
        "topic",
        "record_index",
        to_ms(F.col("log_time_ns") - F.col("pub_ns")).alias("log_minus_publish_ms"),
        to_ms(F.col("header_time_ns") - F.col("pub_ns")).alias("header_minus_publish_ms"),
    )


# --- timestamp repair ---

_ROBUST = HeadTimestamp()


def _fit_sql(rounds: int = 4) -> str:
    parts = [
        f"""WITH {CAMERA_SQL},
nom AS (SELECT topic, min_by(header_ns, fr) AS origin_ns, count(*) AS frames,
 round_even(quantile_cont(step_ns / 1e6, 0.5) FILTER (step_ns / 1e6 BETWEEN 25 AND 50) * 1e6, 0)::BIGINT AS period_ns FROM cedge GROUP BY topic),
base AS (SELECT c.topic, c.fr, c.header_ns, origin_ns, frames, period_ns, (header_ns::DOUBLE - origin_ns::DOUBLE)::BIGINT - fr * period_ns AS d FROM cam c JOIN nom USING (topic)),
f0 AS (SELECT topic, quantile_cont(d, 0.5) AS centre, first(period_ns) * 0.35::DOUBLE AS lim, 0.0::DOUBLE AS mi, 0.0::DOUBLE AS mo, 0.0::DOUBLE AS dr FROM base GROUP BY topic)"""
    ]
    for k in range(1, rounds + 1):
        parts.append(
            f"""a{k} AS (SELECT b.*, f.* EXCLUDE (topic), abs(d - (mo + dr * (fr - mi)) - centre) <= lim AS anchor FROM base b JOIN f{k - 1} f USING (topic)),
s{k} AS (SELECT topic, count(*) FILTER (anchor) AS n, sum(fr) FILTER (anchor) AS sx, sum(d) FILTER (anchor) AS sd, sum(fr * fr) FILTER (anchor) AS sxx, sum(fr * d) FILTER (anchor) AS sxd FROM a{k} GROUP BY topic),
l{k} AS (SELECT topic, n, sx::DOUBLE / n AS nmi, sd::DOUBLE / n AS nmo, (n * sxd - sx * sd)::DOUBLE / (n * sxx - sx * sx)::DOUBLE AS ndr FROM s{k}),
r{k} AS (SELECT a.*, l.n, nmi, nmo, ndr, d - nmo - ndr * (fr - nmi) AS res FROM a{k} a JOIN l{k} l USING (topic)),
c{k} AS (SELECT topic, quantile_cont(res, 0.5) FILTER (anchor) AS med FROM r{k} GROUP BY topic),
f{k} AS (SELECT topic, CASE WHEN first(n) >= 20 THEN first(med) ELSE first(centre) END AS centre,
 CASE WHEN first(n) >= 20 THEN greatest(first(period_ns) * 0.35::DOUBLE, 4.5::DOUBLE * 1.4826::DOUBLE * quantile_cont(abs(res - med), 0.5) FILTER (anchor)) ELSE first(lim) END AS lim,
 CASE WHEN first(n) >= 20 THEN first(nmi) ELSE first(mi) END AS mi, CASE WHEN first(n) >= 20 THEN first(nmo) ELSE first(mo) END AS mo,
 CASE WHEN first(n) >= 20 THEN first(ndr) ELSE first(dr) END AS dr FROM r{k} JOIN c{k} USING (topic) GROUP BY topic)"""
        )
    parts.append(
        f"""last AS (SELECT b.*, abs(d - (mo + dr * (fr - mi)) - centre) <= lim AS anchor FROM base b JOIN f{rounds} f USING (topic)),
ls AS (SELECT topic, count(*) FILTER (anchor) AS n, sum(fr) FILTER (anchor) AS sx, sum(d) FILTER (anchor) AS sd, sum(fr * fr) FILTER (anchor) AS sxx, sum(fr * d) FILTER (anchor) AS sxd FROM last GROUP BY topic),
fit AS (SELECT topic, n AS anchor_count, sx::DOUBLE / n AS mi, sd::DOUBLE / n AS mo, (n * sxd - sx * sd)::DOUBLE / (n * sxx - sx * sx)::DOUBLE AS dr FROM ls),
pred AS (SELECT b.*, anchor_count, period_ns + dr AS fitted, round_even(fr * period_ns + (mo + dr * (fr - mi)) + origin_ns::DOUBLE, 0)::BIGINT AS predicted_ns FROM base b JOIN fit USING (topic)),
look AS (SELECT *, header_ns::DOUBLE - predicted_ns::DOUBLE AS res, abs(header_ns::DOUBLE - predicted_ns::DOUBLE) AS own,
 lag(header_ns) OVER w AS p, lag(abs(header_ns::DOUBLE - predicted_ns::DOUBLE)) OVER w AS pr, lead(header_ns) OVER w AS nx, lead(abs(header_ns::DOUBLE - predicted_ns::DOUBLE)) OVER w AS nr
 FROM pred WINDOW w AS (PARTITION BY topic ORDER BY fr)),
inv AS (SELECT *, own > period_ns * 0.35::DOUBLE
 OR coalesce(abs(header_ns - p - period_ns) > period_ns * 0.2::DOUBLE AND (header_ns - p <= 0 OR greatest(pr, own) > period_ns * 0.35::DOUBLE) AND own >= pr, false)
 OR coalesce(abs(nx - header_ns - period_ns) > period_ns * 0.2::DOUBLE AND (nx - header_ns <= 0 OR greatest(own, nr) > period_ns * 0.35::DOUBLE) AND nr < own, false) AS invalid FROM look),
isl AS (SELECT *, CASE WHEN invalid THEN fr - row_number() OVER (PARTITION BY topic, invalid ORDER BY fr) END AS run FROM inv),
runs AS (SELECT topic, run, min(fr) AS start_frame, max(fr) AS end_frame, arg_min_null(p, fr) AS left_ns, arg_max_null(nx, fr) AS right_ns, count(*) AS frames_in_run, first(period_ns) AS period_ns
 FROM isl WHERE invalid GROUP BY topic, run),
kinds AS (SELECT *, left_ns IS NOT NULL AND right_ns IS NOT NULL AS bounded, CASE WHEN left_ns IS NOT NULL AND right_ns IS NOT NULL AND frames_in_run <= 6
 AND abs(right_ns - left_ns - (frames_in_run + 1) * period_ns) <= (frames_in_run + 1) * period_ns * 0.3::DOUBLE THEN 'local_interpolation' ELSE 'robust_regression' END AS method FROM runs),
fixed AS (SELECT i.*, coalesce(method, 'original') AS repair_method, CASE method
 WHEN 'local_interpolation' THEN round_even((fr - start_frame + 1) * ((right_ns - left_ns) / (frames_in_run + 1)::DOUBLE) + left_ns::DOUBLE, 0)::BIGINT
 WHEN 'robust_regression' THEN predicted_ns ELSE header_ns END AS corrected_ns FROM isl i LEFT JOIN kinds k ON i.topic = k.topic AND i.run = k.run),
done AS (SELECT *, corrected_ns - header_ns AS correction_ns, abs(corrected_ns - header_ns) / period_ns::DOUBLE AS periods,
 CASE WHEN abs(corrected_ns - header_ns) / period_ns::DOUBLE >= 2 THEN 'high' WHEN abs(corrected_ns - header_ns) / period_ns::DOUBLE >= 1 THEN 'warning' ELSE 'none' END AS risk FROM fixed)"""
    )
    return ",\n".join(parts)


_FIT_SQL = _fit_sql()


@query("nominal_period", f"{_FIT_SQL} SELECT topic, origin_ns, frames, period_ns FROM nom")
def nominal_period(spark, folder):
    return repair.nominal_period(camera(spark, folder), "header_ns", _ROBUST)


@query(
    "robust_fit",
    f"""{_FIT_SQL} SELECT topic, first(period_ns) AS period_ns, first(anchor_count) AS anchor_count, round(first(anchor_count) / count(*)::DOUBLE, 6) AS anchor_ratio,
 round(first(fitted), 3) AS fitted_period_ns FROM pred GROUP BY topic""",
)
def robust_fit(spark, folder):
    line = kept(camera(spark, folder))
    fit = repair.robust_fit(line, "fr", "header_ns", repair.nominal_period(line, "header_ns", _ROBUST), _ROBUST)
    return settle(
        fit.select("topic", "period_ns", "anchor_count", F.round("anchor_ratio", 6).alias("anchor_ratio"), F.round("fitted_period_ns", 3).alias("fitted_period_ns"))
    )


def _marked(spark, folder):
    return repair.marked_frames(camera(spark, folder), "fr", "header_ns", _ROBUST)


@query("invalid_frames", f"{_FIT_SQL} SELECT topic, fr, invalid, round(res / 1000, 0) AS residual_us FROM inv")
def invalid_frames(spark, folder):
    return _marked(spark, folder).rows().select("topic", "fr", "invalid", F.round(F.col("residual_ns") / 1000, 0).alias("residual_us"))


@query(
    "repair_runs",
    f"{_FIT_SQL} SELECT topic, start_frame, end_frame, frames_in_run, bounded, method FROM kinds",
)
def repair_runs(spark, folder):
    runs = repair.repair_runs(_marked(spark, folder).df, ["topic"], _ROBUST)
    return runs.select("topic", "start_frame", "end_frame", "frames_in_run", "bounded", "method")


@query(
    "timestamp_repair",
    f"""{_FIT_SQL} SELECT topic, fr, header_ns, corrected_ns, repair_method, risk,
 round(correction_ns / 1e6, 6) AS correction_ms, round(periods, 6) AS correction_periods FROM done""",
)
def timestamp_repair(spark, folder):
    repaired = repair.repair_timestamps(camera(spark, folder), "fr", "header_ns", _ROBUST)
    return settle(
        repaired.rows().select(
            "topic", "fr", "header_ns", "corrected_ns", "repair_method", "risk", "correction_ms", "correction_periods"
        )
    )


@query(
    "repair_diagnostics",
    f"""{_FIT_SQL} SELECT topic, count(*) AS frames, count(*) FILTER (invalid) AS invalid_frame_count, count(*) FILTER (correction_ns <> 0) AS changed_frame_count,
 round(max(abs(correction_ns) / 1e6), 3) AS max_abs_correction_ms, count(*) FILTER (risk = 'warning') AS warning_frame_count, count(*) FILTER (risk = 'high') AS high_risk_frame_count,
 count(*) FILTER (repair_method = 'original') AS original_count, count(*) FILTER (repair_method = 'local_interpolation') AS local_interpolation_count,
 count(*) FILTER (repair_method = 'robust_regression') AS robust_regression_count, 0::BIGINT AS monotonic_guard_count,
 round(quantile_cont(abs(correction_ns) / 1e6, 0.95), 3) AS p95_abs_correction_ms FROM done GROUP BY topic""",
)
def repair_diagnostics(spark, folder):
    bound = _bound(spark, folder)
    repaired = repair.repair_timestamps(camera(spark, folder), "fr", "header_ns", _ROBUST)
    return settle(repair.repair_diagnostics(repaired.df, ["topic"], bound=bound), 3)


@query(
    "monotonic_guard",
    f"""WITH RECURSIVE {CAMERA_SQL}, g AS (
 SELECT topic, fr, header_ns AS corrected_ns, 'original' AS repair_method FROM cam WHERE fr = 0
 UNION ALL SELECT c.topic, c.fr, CASE WHEN c.header_ns <= g.corrected_ns THEN greatest(c.fr * 33333000, g.corrected_ns + 26666400) ELSE c.header_ns END,
 CASE WHEN c.header_ns <= g.corrected_ns THEN 'monotonic_guard' ELSE 'original' END
 FROM g JOIN cam c ON c.topic = g.topic AND c.fr = g.fr + 1) SELECT topic, fr, corrected_ns, repair_method FROM g""",
)
def monotonic_guard(spark, folder):
    """The guard alone, on a clock whose faults nothing else has repaired."""
    line = camera(spark, folder).derive(
        {
            "corrected_ns": F.col("header_ns"),
            "predicted_ns": F.col("fr") * FRAME_NS,
            "period_ns": F.lit(FRAME_NS).cast("bigint"),
            "repair_method": F.lit("original"),
        }
    )
    return repair.monotonic_guard(line, _ROBUST).rows().select("topic", "fr", "corrected_ns", "repair_method")


@query(
    "affine_repair",
    f"""WITH {CAMERA_SQL}, so AS (SELECT topic, record_index, header_ns, row_number() OVER w - 1 AS i, header_ns - lag(header_ns) OVER w AS s FROM cam WINDOW w AS (PARTITION BY topic ORDER BY header_ns, record_index)),
 e AS (SELECT topic, min(header_ns) AS f, max(header_ns) AS l, count(*) AS n, count(*) FILTER (s <= 0) AS bad FROM so GROUP BY topic)
 SELECT topic, record_index, bad AS nonpositive_source_steps, CASE WHEN bad = 0 THEN header_ns WHEN i = n - 1 THEN l ELSE round_even(i * ((l - f) / (n - 1)::DOUBLE) + f::DOUBLE, 0)::BIGINT END AS repaired_ns FROM so JOIN e USING (topic)""",
)
def affine_repair(spark, folder):
    from telemark.functions.sequence import track

    rows = camera(spark, folder).rows().select("topic", "record_index", "header_ns")
    line = track(rows, ["topic"], ["header_ns", "record_index"], bound=_bound(spark, folder))
    fixed = repair.affine_repair(carry(line, number="i"), "i", "header_ns")
    return fixed.select("topic", "record_index", "nonpositive_source_steps", "repaired_ns")


@query(
    "patch_plan",
    f"""{_FIT_SQL} SELECT topic, record_index, round(corrected_ns / 1000.0::DOUBLE, 0) AS corrected_us FROM done JOIN cam USING (topic, fr) WHERE corrected_ns <> done.header_ns""",
)
def patch_plan(spark, folder):
    """The frames whose header a writer has to rewrite."""
    repaired = repair.repair_timestamps(camera(spark, folder), "fr", "header_ns", _ROBUST).rows()
    changed = repaired.filter(F.col("correction_ns") != 0)
    return changed.select("topic", "record_index", F.round(F.col("corrected_ns") / 1000.0, 0).alias("corrected_us"))


@query("event_value_counts", "SELECT event_type AS topic, user_id % 10 AS frame_id, count(*) AS rows FROM events GROUP BY ALL")
def event_value_counts(spark, folder):
    rows = read(spark, folder, "events").select(F.col("event_type").alias("topic"), (F.col("user_id") % 10).alias("frame_id"))
    return value_counts(rows, ["topic"], "frame_id")
