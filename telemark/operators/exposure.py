"""Overexposure per camera, against absolute thresholds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemark.config import Exposure
from telemark.functions.quantile import summarise
from telemark.functions.scalar import array_percentile, linear_light
from telemark.functions.sequence import Track, run_extent

DISTRIBUTION = {"min": 0.0, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99, "max": 1.0}
METRICS = ("l50", "l95", "highlight_clipping_ratio")

# Luminance weights of linear red, green and blue.
RED, GREEN, BLUE = 0.2126, 0.7152, 0.0722


def luminance(red: Column, green: Column, blue: Column) -> Column:
    """Relative luminance of sRGB samples in [0, 1]."""
    return RED * linear_light(red) + GREEN * linear_light(green) + BLUE * linear_light(blue)


def luminance_metrics(samples: Column, config: Exposure | None = None) -> dict[str, Column]:
    """Median, 95th percentile and clipped share of an array of luminances."""
    config = config or Exposure()
    ascending = F.array_sort(samples)
    clipped = F.size(F.filter(samples, lambda y: y > config.clip_luminance))
    return {
        "l50": array_percentile(ascending, 0.50),
        "l95": array_percentile(ascending, 0.95),
        "highlight_clipping_ratio": clipped / F.size(samples),
    }


def clipping_mask(samples: Column, config: Exposure | None = None) -> Column:
    """Which samples are clipped: the predicate behind a mask picture."""
    limit = (config or Exposure()).clip_luminance
    return F.transform(samples, lambda y: y > limit)


def image_luminance_metrics(images: DataFrame, image: str = "image", config: Exposure | None = None) -> DataFrame:
    """The same metrics for decoded frames (blue-green-red bytes, Spark image struct).

    Pixels leave the JVM in small Arrow batches; only three numbers come back.
    """
    config = config or Exposure()
    stride, clip = config.pixel_stride, config.clip_luminance
    code = np.arange(256, dtype=np.float32) / 255.0
    table = np.where(code <= 0.04045, code / 12.92, ((code + 0.055) / 1.055) ** 2.4)
    result = T.StructType([T.StructField(name, T.DoubleType()) for name in METRICS])

    @F.pandas_udf(result)
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for height, width, channels, data in zip(
                batch["height"], batch["width"], batch["nChannels"], batch["data"], strict=True
            ):
                pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)[::stride, ::stride]
                blue, green, red = (pixels[..., i if channels >= 3 else 0] for i in range(3))
                light = RED * table[red] + GREEN * table[green] + BLUE * table[blue]
                low, high = np.percentile(light, [50, 95])
                rows.append((float(low), float(high), float(np.mean(light > clip))))
            yield pd.DataFrame(rows, columns=list(METRICS))

    picture = F.struct(*[F.col(f"{image}.{name}") for name in ("height", "width", "nChannels", "data")])
    return images.withColumn("_m", measure(picture)).select("*", "_m.*").drop("_m")


def candidate_flags(config: Exposure | None = None) -> dict[str, Column]:
    config = config or Exposure()
    broad = (F.col("l50") >= config.overexposed_l50_threshold) & (F.col("l95") >= config.overexposed_l95_threshold)
    clipping = F.col("highlight_clipping_ratio") >= config.clip_ratio_threshold
    return {
        "broad_overexposure_candidate": broad,
        "highlight_clipping_candidate": clipping,
        "candidate": broad | clipping,
    }


def confirmed_frames(frames: Track, frame: str, config: Exposure | None = None) -> DataFrame:
    """Frames with their candidate run and whether it is long enough to count."""
    return confirmed_runs(frames, frame, config).rows()


def confirmed_runs(frames: Track, frame: str, config: Exposure | None = None) -> Track:
    config = config or Exposure()
    runs = run_extent(frames, F.col("candidate"), frame)
    length = F.col("run_last") - F.col("run_first") + 1
    confirmed = F.coalesce(length >= config.minimum_consecutive_frames, F.lit(False))
    return runs.derive({"confirmed": confirmed})


def exposure_segments(confirmed: DataFrame, keys: Sequence[str], frame: str, carried: Sequence[str] = ()) -> DataFrame:
    """One row per confirmed run; ``carried`` columns are kept from both its ends."""
    ends = [
        value
        for name in carried
        for value in (F.min_by(name, frame).alias(f"start_{name}"), F.max_by(name, frame).alias(f"end_{name}"))
    ]
    return (
        confirmed.filter("confirmed")
        .groupBy(*keys, F.col("run_first").alias("start_frame"))
        .agg(
            F.max(frame).alias("end_frame"),
            F.count("*").alias("frame_count"),
            F.count_if("broad_overexposure_candidate").alias("broad_overexposure_frame_count"),
            F.count_if("highlight_clipping_candidate").alias("highlight_clipping_frame_count"),
            *[F.max(name).alias(f"max_{name}") for name in METRICS],
            *ends,
        )
    )


def exposure_summary(confirmed: DataFrame, keys: Sequence[str], *, bound: int | None = None) -> DataFrame:
    """Distribution of the metrics and the frame counts per camera."""
    wanted = {m: (F.col(m), {f"{m}_{name}": q for name, q in DISTRIBUTION.items()}) for m in METRICS}
    plain = [
        F.count("*").alias("analyzed_frames"),
        F.count_if("candidate").alias("candidate_frames"),
        F.count_if("confirmed").alias("confirmed_frames"),
    ]
    return summarise(confirmed, keys, plain, wanted, bound=bound)


def exposure_status(confirmed: DataFrame, episode: Sequence[str]) -> DataFrame:
    return confirmed.groupBy(*episode).agg(
        F.when(F.count_if("confirmed") > 0, "warning").otherwise("pass").alias("status")
    )
