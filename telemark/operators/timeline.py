"""Timestamp quality of a stream: steps, gaps, jitter buckets."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telemark.config import TimestampQuality
from telemark.functions.quantile import summarise
from telemark.functions.scalar import to_ms, to_seconds
from telemark.functions.sequence import Track, carry

_BASIC = {"median": 0.5, "p95": 0.95}
_SPREAD = {"median": 0.5, "p95": 0.95, "p99": 0.99}


def steps(stream: Track, time: str) -> Track:
    """``step_ns`` and ``dt_ms`` from the previous row; null on the first row."""
    stream = carry(stream, prev={"_before": F.col(time)})
    stepped = stream.derive({"step_ns": F.col(time) - F.col("_before")})
    stepped = stepped.derive({"dt_ms": to_ms(F.col("step_ns"))})
    return replace(stepped, df=stepped.df.drop("_before"))


def _ends(stream: Track, time: str) -> list[Column]:
    """First and last time in row order, which need not be the extremes."""
    return [
        F.min_by(time, stream.position).alias("_first"),
        F.max_by(time, stream.position).alias("_last"),
        F.count("*").alias("count"),
    ]


def _rate(df: DataFrame, guarded: bool = True) -> DataFrame:
    duration = to_seconds(F.col("_last") - F.col("_first"))
    hz = F.try_divide(F.col("count") - 1, duration)
    df = df.withColumns({"duration_s": duration, "effective_hz": F.coalesce(hz, F.lit(0.0)) if guarded else hz})
    return df.drop("_first", "_last")


def distribution(value: Column, name: str, prefix: str = "") -> tuple[list[Column], dict]:
    """min, mean, max, std and the three percentiles of a value, all null when empty."""
    plain = [
        F.min(value).alias(f"{prefix}min"),
        F.avg(value).alias(f"{prefix}mean"),
        F.max(value).alias(f"{prefix}max"),
        F.stddev_pop(value).alias(f"{prefix}std"),
    ]
    return plain, {name: (value, {f"{prefix}{q}": fraction for q, fraction in _SPREAD.items()})}


def timestamp_metrics(stream: Track, time: str) -> DataFrame:
    """Count, duration, rate and the full step distribution per stream."""
    plain, wanted = distribution(F.col("dt_ms"), "dt_ms", "dt_")
    plain = [*_ends(stream, time), *plain, F.count_if(F.col("dt_ms") <= 0).alias("nonpositive")]
    return _rate(summarise(steps(stream, time).df, stream.keys, plain, wanted, largest=stream.largest))


def series_stats(stream: Track, time: str, *, guarded: bool = False) -> DataFrame:
    """The short form: rate, median, p95 and largest step."""
    plain = [
        *_ends(stream, time),
        F.max("dt_ms").alias("dt_max"),
        F.count_if(F.col("dt_ms") <= 0).alias("nonpositive"),
    ]
    wanted = {"dt_ms": (F.col("dt_ms"), {f"dt_{q}": fraction for q, fraction in _BASIC.items()})}
    return _rate(summarise(steps(stream, time).df, stream.keys, plain, wanted, largest=stream.largest), guarded)


def period_label(dt_ms: Column, multiple: Column, epsilon_ms: float) -> Column:
    whole = F.greatest(F.lit(1), F.rint(multiple).cast("bigint"))
    return (
        F.when(dt_ms <= epsilon_ms, "nonpositive_or_duplicate")
        .when(whole < 5, F.concat(whole.cast("string"), F.lit("T")))
        .otherwise(">=5T")
    )


def gap_severity(dt_ms: Column, warning_ms: Column, fail_ms: Column) -> Column:
    return F.when(dt_ms > fail_ms, "fail").when(dt_ms > warning_ms, "warning").otherwise("info")


def _paced(stream: Track, time: str, config: TimestampQuality) -> DataFrame:
    """Steps joined with their stream's nominal period and gap limits."""
    edges = steps(stream, time).df.filter(F.col("dt_ms").isNotNull())
    regular = F.when(F.col("dt_ms") > config.duplicate_epsilon_ms, F.col("dt_ms"))
    nominal = summarise(edges, stream.keys, [], {"dt": (regular, {"nominal_period_ms": 0.5})}, largest=stream.largest)
    nominal = _gap_limits(nominal, config)
    multiple = F.coalesce(F.col("dt_ms") / F.col("nominal_period_ms"), F.lit(0.0))
    return edges.join(nominal, list(stream.keys)).withColumn("period_multiple", multiple)


def gap_statistics(stream: Track, time: str, config: TimestampQuality | None = None) -> DataFrame:
    """Step distribution, nominal period, gap limits and threshold counts per stream."""
    config = config or TimestampQuality()
    epsilon, dt = config.duplicate_epsilon_ms, F.col("dt_ms")
    plain, wanted = distribution(dt, "dt_ms", "dt_")
    stepped = steps(stream, time).df
    counts = [
        F.count_if(dt < -epsilon).alias("negative_count"),
        F.count_if(dt <= epsilon).alias("nonpositive_count"),
        F.count_if(F.abs(dt) <= epsilon).alias("duplicate_count"),
    ]
    regular = {"regular": (F.when(dt > epsilon, dt), {"nominal_period_ms": 0.5})}
    first_look = summarise(
        stepped, stream.keys, [*_ends(stream, time), *plain, *counts], {**wanted, **regular}, largest=stream.largest
    )
    limited = _gap_limits(first_look, config)
    # The small table rides along, so its percentiles are computed once.
    held = [F.first(c).alias(c) for c in limited.columns if c not in stream.keys]
    judged = stepped.select(*stream.keys, "dt_ms").join(limited, list(stream.keys)).groupBy(*stream.keys)
    over = [
        F.count_if(dt > F.col("gap_warning_ms")).alias("warning_gap_count"),
        F.count_if(dt > F.col("gap_fail_ms")).alias("fail_gap_count"),
    ]
    return _rate(judged.agg(*held, *over))


def _gap_limits(nominal: DataFrame, config: TimestampQuality) -> DataFrame:
    return nominal.withColumns(
        {
            "gap_warning_ms": F.col("nominal_period_ms") * config.gap_warning_factor,
            "gap_fail_ms": F.col("nominal_period_ms") * config.gap_fail_factor,
        }
    )


def period_multiples(stream: Track, time: str, config: TimestampQuality | None = None) -> DataFrame:
    """How many steps fall on each multiple of the nominal period."""
    config = config or TimestampQuality()
    label = period_label(F.col("dt_ms"), F.col("period_multiple"), config.duplicate_epsilon_ms)
    paced = _paced(stream, time, config).withColumn("period_bucket", label)
    return paced.groupBy(*stream.keys, "period_bucket").agg(F.count("*").alias("steps"))


def gap_events(stream: Track, time: str, index: str, config: TimestampQuality | None = None) -> DataFrame:
    """Every step longer than 1.5 nominal periods, with its severity."""
    config = config or TimestampQuality()
    paced = _paced(stream, time, config).filter(F.col("dt_ms") > 1.5 * F.col("nominal_period_ms"))
    return paced.select(
        *stream.keys,
        (F.col(index) - 1).alias("edge_after_source_index"),
        F.col("dt_ms").alias("gap_ms"),
        "period_multiple",
        gap_severity(F.col("dt_ms"), F.col("gap_warning_ms"), F.col("gap_fail_ms")).alias("severity"),
    )


def judged_steps(stream: Track, time: str, nominal_ns: Column, tolerance_ratio: float = 0.20) -> DataFrame:
    """Steps with the flag ``normal`` and the rounded multiple of the nominal period."""
    edges = steps(stream, time).df.filter(F.col("step_ns").isNotNull())
    return edges.withColumns(
        {
            "deviation_ns": F.abs(F.col("step_ns") - nominal_ns),
            "normal": F.abs(F.col("step_ns") - nominal_ns) <= nominal_ns * tolerance_ratio,
            "period_multiple": F.col("step_ns") / nominal_ns,
            "rounded_multiple": F.rint(F.col("step_ns") / nominal_ns).cast("bigint"),
        }
    )


def step_anomalies(judged: DataFrame, keys) -> DataFrame:
    return judged.groupBy(*keys).agg(
        F.count_if("normal").alias("normal_count"),
        F.count_if(~F.col("normal")).alias("anomaly_count"),
        F.count_if(F.col("step_ns") == 0).alias("duplicate_count"),
        F.count_if(F.col("step_ns") < 0).alias("negative_count"),
    )


def anomaly_multiples(judged: DataFrame, keys) -> DataFrame:
    return judged.filter(~F.col("normal")).groupBy(*keys, "rounded_multiple").agg(F.count("*").alias("steps"))


def top_rows(df: DataFrame, keys, order: list[Column], limit: int, rank: str = "place") -> DataFrame:
    """The first ``limit`` rows per key in the given order, numbered from one.

    Spark applies the row-number limit before the shuffle as well, so a hot key
    sends at most ``limit`` rows per task.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col(rank) <= limit).withColumn(rank, F.col(rank).cast("bigint"))
