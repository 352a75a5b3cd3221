"""Fixed-rate mapping of episodes, its lineage, counters and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark.functions.quantile import summarise
from telemark.functions.scalar import primary_time, slug, to_ms, topic_category
from telemark.functions.sequence import Track, carry
from telemark.operators.align import align_to_grid, common_spans, integer_grid
from telemark.operators.timeline import distribution


def source_samples(messages: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """Lineage of every sample: original and cleaned time, correction, method, risk."""
    cleaned = primary_time()
    if corrections is None:
        fixes = {
            "original_header_time_ns": F.col("header_time_ns"),
            "cleaning_correction_ms": F.lit(0.0),
            "repair_method": F.lit("original"),
            "risk": F.lit("none"),
        }
        joined = messages
    else:
        side = corrections.select(
            "episode",
            F.col("mcap_record_index").alias("record_index"),
            F.col("header_time_ns").alias("_raw"),
            F.col("correction_ms").alias("_shift"),
            F.col("repair_method").alias("_method"),
            F.col("risk").alias("_risk"),
            F.lit(True).alias("_found"),
        )
        joined = messages.join(side, ["episode", "record_index"], "left")
        fixes = {
            "original_header_time_ns": F.when(F.col("_found"), F.col("_raw")).otherwise(F.col("header_time_ns")),
            "cleaning_correction_ms": F.coalesce("_shift", F.lit(0.0)),
            "repair_method": F.coalesce(F.nullif("_method", F.lit("")), F.lit("original")),
            "risk": F.coalesce(F.nullif("_risk", F.lit("")), F.lit("none")),
        }
    return joined.select(
        "episode",
        "topic",
        F.col("topic_index").alias("source_index"),
        F.col("record_index").alias("mcap_record_index"),
        "source_file",
        "sequence",
        fixes["original_header_time_ns"].alias("original_header_time_ns"),
        F.col("header_time_ns").alias("cleaned_header_time_ns"),
        "publish_time_ns",
        "log_time_ns",
        F.coalesce(fixes["original_header_time_ns"], cleaned).alias("original_primary_time_ns"),
        cleaned.alias("cleaned_primary_time_ns"),
        fixes["cleaning_correction_ms"].alias("cleaning_correction_ms"),
        fixes["repair_method"].alias("repair_method"),
        fixes["risk"].alias("risk"),
    )


def stream_violations(stream: Track, time: str) -> DataFrame:
    """Streams that cannot be aligned: too short, or not strictly increasing."""
    checked = carry(stream, prev={"_before": F.col(time)}).df
    counts = checked.groupBy(*stream.keys).agg(
        F.count("*").alias("samples"), F.count_if(F.col(time) <= F.col("_before")).alias("nonincreasing")
    )
    reason = F.when(F.col("samples") < 2, "fewer than two samples").when(
        F.col("nonincreasing") > 0, "non-increasing timestamps"
    )
    return counts.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def target_mappings(stream: Track, episode: Sequence[str], fps: float, time: str, original: str, index: str) -> DataFrame:
    """One row per stream and target: chosen source, residuals, reuse flag."""
    topic = next(k for k in stream.keys if k not in episode)
    spans = integer_grid(common_spans(stream.df, episode, topic, time), fps)
    mapped = align_to_grid(
        stream, spans, episode, time, {"source_index": F.col(index), "original_time_ns": F.col(original)}
    )
    return mapped.select(
        *stream.keys,
        "target_index",
        "target_time_ns",
        "source_index",
        F.col("source_time_ns").alias("cleaned_time_ns"),
        "original_time_ns",
        "residual_ns",
        to_ms(F.col("residual_ns")).alias("residual_ms"),
        to_ms(F.col("original_time_ns") - F.col("target_time_ns")).alias("raw_to_target_residual_ms"),
        "reused_previous_source",
    )


def unique_selection(mappings: DataFrame, keys: Sequence[str]) -> DataFrame:
    return mappings.select(*keys, "source_index").distinct()


def mapping_counters(mappings: DataFrame, sources: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Selected, omitted and reused counts per stream.

    A source is chosen again only right after it was chosen, so the first use of
    each source is the row whose reuse flag is off; no distinct is needed.
    """
    keys = list(keys)
    used = mappings.groupBy(*keys).agg(
        F.count("*").alias("target_count"),
        F.count_if(~F.col("reused_previous_source")).alias("selected_unique_count"),
        F.count_if("reused_previous_source").alias("reused_target_count"),
    )
    have = sources.groupBy(*keys).agg(F.count("*").alias("source_count"))
    omitted = F.col("source_count") - F.col("selected_unique_count")
    return have.join(used, keys).withColumns(
        {
            "omitted_source_count": omitted,
            "omitted_source_ratio": omitted / F.col("source_count"),
            "reused_target_ratio": F.col("reused_target_count") / F.col("target_count"),
        }
    )


def residual_stats(
    rows: DataFrame, keys: Sequence[str], residual_ms: Column, *, bound: int | None = None
) -> DataFrame:
    """Signed and absolute distributions and the past/exact/future split."""
    rows = rows.withColumn("_r", residual_ms).withColumn("_a", F.abs("_r"))
    signed, signed_q = distribution(F.col("_r"), "signed", "signed_")
    absolute, absolute_q = distribution(F.col("_a"), "absolute", "abs_")
    split = [
        F.count_if(F.col("_r") < 0).alias("past_source_count"),
        F.count_if(F.col("_r") == 0).alias("exact_source_count"),
        F.count_if(F.col("_r") > 0).alias("future_source_count"),
    ]
    return summarise(rows, keys, [*signed, *absolute, *split], {**signed_q, **absolute_q}, bound=bound)


def threshold_exceedance(
    rows: DataFrame, keys: Sequence[str], residual_ms: Column, thresholds_ms: Sequence[float]
) -> DataFrame:
    """How many residuals exceed each limit: all limits in one pass, then unpivoted."""
    absolute = F.abs(residual_ms)
    counted = rows.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.array(*[F.count_if(absolute > t) for t in thresholds_ms]).alias("_over")
    )
    limits = F.array(*[F.lit(float(t)) for t in thresholds_ms])
    each = counted.select(*keys, "_n", F.explode(F.arrays_zip(limits.alias("threshold_ms"), F.col("_over").alias("exceeded"))).alias("_e"))
    return each.select(*keys, "_e.threshold_ms", "_e.exceeded", (F.col("_e.exceeded") / F.col("_n")).alias("ratio"))


def topic_pairs(mappings: DataFrame, episode: Sequence[str], topics: Sequence[str] = (), topic: str = "topic") -> DataFrame:
    """Skew between the selected times of every two streams at each target.

    The streams of one target are folded into an array (one entry a stream), and its
    pairs are read from it: one shuffle instead of a self-join.  Listed ``topics`` come
    first and in their order, any others follow by name; none is left out.  A target of
    n streams has n(n-1)/2 pairs, by definition of the report.
    """
    episode = list(episode)
    place = F.lit(len(topics))
    for rank, name in enumerate(topics):
        place = F.when(F.col(topic) == name, F.lit(rank)).otherwise(place)
    chosen = F.struct(place.alias("place"), F.col(topic).alias("topic"), F.col("cleaned_time_ns").alias("at"))
    timed = mappings.filter(F.col("cleaned_time_ns").isNotNull())
    frame = timed.groupBy(*episode, "target_index").agg(F.array_sort(F.collect_list(chosen)).alias("_at"))

    def pairs_of(left: Column, at: Column) -> Column:
        later = F.slice("_at", at + 2, F.size("_at"))
        return F.transform(
            later,
            lambda right: F.struct(
                left["topic"].alias("left_topic"), right["topic"].alias("right_topic"), (left["at"] - right["at"]).alias("skew_ns")
            ),
        )

    rows = frame.select(*episode, "target_index", F.explode(F.flatten(F.transform("_at", pairs_of))).alias("_pair"))
    return rows.select(*episode, "target_index", "_pair.*")


def diagnostic_metrics(mappings: DataFrame, samples: DataFrame, fps: float, prefix: str = "/resampling/") -> DataFrame:
    """Per-stream diagnostic messages: topic, time and JSON body."""
    extra = samples.select("episode", "topic", "source_index", "cleaning_correction_ms", "repair_method", "risk")
    rows = mappings.join(extra, ["episode", "topic", "source_index"])
    body = F.to_json(
        F.struct(
            "target_index",
            "target_time_ns",
            (F.col("target_index") / F.lit(float(fps))).alias("target_elapsed_s"),
            "source_index",
            F.col("cleaned_time_ns").alias("source_time_ns"),
            "original_time_ns",
            "residual_ms",
            F.abs("residual_ms").alias("abs_residual_ms"),
            "raw_to_target_residual_ms",
            "cleaning_correction_ms",
            "reused_previous_source",
            "repair_method",
            "risk",
        )
    )
    name = F.concat(F.lit(prefix), slug(F.col("topic")))
    return rows.select("episode", name.alias("topic"), F.col("topic").alias("source_topic"), "target_index", "target_time_ns", body.alias("body"))


def diagnostic_skew(pairs: DataFrame, targets: DataFrame, fps: float, topic: str = "/resampling/cross_stream") -> DataFrame:
    """Per-target message with the skew of every pair as one JSON object."""
    name = F.concat(slug(F.col("left_topic")), F.lit("__"), slug(F.col("right_topic")), F.lit("_ms"))
    folded = pairs.groupBy("episode", "target_index").agg(
        F.map_from_entries(F.collect_list(F.struct(name, to_ms(F.col("skew_ns"))))).alias("_skew")
    )
    rows = folded.join(targets, ["episode", "target_index"])
    fixed = F.to_json(
        F.struct("target_index", "target_time_ns", (F.col("target_index") / F.lit(float(fps))).alias("target_elapsed_s"))
    )
    skew = F.to_json("_skew")
    body = F.concat(F.expr("substring({0}, 1, length({0}) - 1)".format("_fixed")), F.lit(","), F.expr("substring(_json, 2)"))
    rows = rows.withColumns({"_fixed": fixed, "_json": skew}).withColumn("body", body)
    return rows.select("episode", F.lit(topic).alias("topic"), "target_index", "target_time_ns", "body")


def stream_categories(stream: DataFrame, keys: Sequence[str], header: str = "header_time_ns") -> DataFrame:
    """Category of each stream and which clock its samples carry."""
    source = F.when(F.count(header) == F.count("*"), "header").otherwise("publish_or_log")
    return stream.groupBy(*keys).agg(F.count("*").alias("source_count"), source.alias("time_source")).withColumn(
        "category", topic_category(F.col("topic"))
    )
