"""Sampling and content metrics of encoded frames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemark.functions.quantile import summarise

SAMPLE_METRICS = ("brightness_mean", "dark_pixel_ratio", "bright_pixel_ratio", "laplacian_variance")


def uniform_sample(frames: DataFrame, keys: Sequence[str], index: str, count: int) -> DataFrame:
    """Evenly spaced frames per stream, first and last included.

    ``index`` runs from zero.  The wanted positions are computed from the stream
    length and joined, so unwanted frames are dropped before anything is decoded.
    """
    size = frames.groupBy(*keys).agg(F.count("*").alias("_n"))
    return frames.join(sample_positions(size, keys, F.col("_n"), count, index), [*keys, index])


def sample_positions(sizes: DataFrame, keys: Sequence[str], length: Column, count: int, index: str) -> DataFrame:
    wanted = F.least(F.lit(max(count, 1)).cast("bigint"), length)
    step = (length - 1) / F.greatest(wanted - 1, F.lit(1))
    spots = F.transform(F.sequence(F.lit(0).cast("bigint"), wanted - 1), lambda i: F.floor(i * step))
    return sizes.select(*keys, F.explode(F.array_distinct(spots)).alias(index))


def encoded_sizes(frames: DataFrame, keys: Sequence[str], size: str, *, bound: int | None = None) -> DataFrame:
    plain = [
        F.min(size).alias("min_bytes"),
        F.max(size).alias("max_bytes"),
        F.sum(size).alias("total_bytes"),
        F.count("*").alias("frames"),
    ]
    return summarise(frames, keys, plain, {"s": (F.col(size), {"median_bytes": 0.5})}, bound=bound)


def value_counts(frames: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return frames.groupBy(*keys, column).agg(F.count("*").alias("rows"))


def hash_duplicates(frames: DataFrame, keys: Sequence[str], payload: Column) -> DataFrame:
    """Distinct contents and surplus copies.

    Grouping by content first means copies meet by hash, and one much-copied
    content costs no task more than a counter.
    """
    per_hash = frames.groupBy(*keys, F.md5(payload).alias("_h")).agg(F.count("*").alias("_c"))
    return per_hash.groupBy(*keys).agg(
        F.count("*").alias("unique_hashes"), F.sum(F.col("_c") - 1).alias("duplicate_hashes")
    )


def laplacian_variance(gray: np.ndarray) -> float:
    """Variance of the four-neighbour Laplacian with mirrored borders."""
    padded = np.pad(gray.astype(np.float64), 1, mode="reflect")
    edges = padded[:-2, 1:-1] + padded[2:, 1:-1] + padded[1:-1, :-2] + padded[1:-1, 2:] - 4 * padded[1:-1, 1:-1]
    return float(edges.var())


def gray_levels(pixels: np.ndarray) -> np.ndarray:
    """Weighted gray of blue-green-red bytes, in whole levels."""
    if pixels.shape[2] < 3:
        return pixels[..., 0]
    blue, green, red = (pixels[..., i].astype(np.float64) for i in range(3))
    return np.rint(0.299 * red + 0.587 * green + 0.114 * blue).astype(np.uint8)


def sample_metrics(images: DataFrame, image: str = "image") -> DataFrame:
    """Brightness, dark and bright share and sharpness of decoded frames."""
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in SAMPLE_METRICS])

    @F.pandas_udf(schema)
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for height, width, channels, data in zip(
                batch["height"], batch["width"], batch["nChannels"], batch["data"], strict=True
            ):
                gray = gray_levels(np.frombuffer(data, np.uint8).reshape(height, width, channels))
                dark, bright = float(np.mean(gray < 10)), float(np.mean(gray > 245))
                rows.append((float(gray.mean()), dark, bright, laplacian_variance(gray)))
            yield pd.DataFrame(rows, columns=list(SAMPLE_METRICS))

    picture = F.struct(*[F.col(f"{image}.{name}") for name in ("height", "width", "nChannels", "data")])
    return images.withColumn("_m", measure(picture)).select("*", "_m.*").drop("_m")


def sample_summary(samples: DataFrame, keys: Sequence[str], metrics: Sequence[str] = SAMPLE_METRICS) -> DataFrame:
    return samples.groupBy(*keys).agg(
        *[f(name).alias(f"{name}_{label}") for name in metrics for label, f in (("min", F.min), ("mean", F.avg), ("max", F.max))]
    )
