"""Independent camera streams of recordings: frames with their origin, then pixels."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemark import contract
from telemark.config import HeadTimestamp
from telemark.functions.scalar import to_ms, to_seconds
from telemark.functions.sequence import track
from telemark.operators.repair import repair_timestamps
from telemark.sources.mcap import fetch

IMAGE = "struct<height:int,width:int,nChannels:int,data:binary>"


def camera_frames(
    messages: DataFrame,
    config: HeadTimestamp | None = None,
    *,
    topics: Sequence[str] = contract.IMAGE_TOPICS,
    max_frames: int | None = None,
) -> DataFrame:
    """Image messages of every camera on its own clock, with full provenance.

    The head camera's stamps are repaired on the fly; other cameras keep theirs.
    ``max_frames`` takes the first frames of each camera, before any byte is read.
    """
    config = config or HeadTimestamp()
    shots = messages.filter(F.col("topic").isin(*topics) & F.col("image").isNotNull())
    head = track(shots.filter(F.col("topic") == config.topic), ["episode", "topic"], ["topic_index"])
    fixed = repair_timestamps(head, "topic_index", "header_time_ns", config).rows()
    fixed = fixed.select("episode", "record_index", "corrected_ns", "correction_ms", "repair_method", "risk")
    shots = shots.join(fixed, ["episode", "record_index"], "left")
    analysis = F.coalesce("corrected_ns", "header_time_ns", "primary_time_ns")
    shots = shots.withColumn("analysis_time_ns", analysis)
    first = shots.groupBy("episode", "topic").agg(F.min_by("analysis_time_ns", "topic_index").alias("_first"))
    shots = shots.join(first, ["episode", "topic"])
    if max_frames is not None:
        shots = shots.filter(F.col("topic_index") < max_frames)
    return shots.select(
        "episode",
        F.col("topic").alias("camera"),
        F.col("topic_index").alias("frame_index"),
        to_seconds(F.col("analysis_time_ns") - F.col("_first")).alias("timestamp_s"),
        "source_file",
        "record_index",
        "sequence",
        "header_time_ns",
        "analysis_time_ns",
        "publish_time_ns",
        "log_time_ns",
        F.coalesce("repair_method", F.lit("original")).alias("timestamp_repair_method"),
        F.coalesce("risk", F.lit("none")).alias("timestamp_risk"),
        F.coalesce("correction_ms", to_ms(F.lit(0))).alias("timestamp_correction_ms"),
        "image",
    )


def decoded(frames: DataFrame, decode: Callable[[bytes], np.ndarray]) -> DataFrame:
    """Replace image pointers by pixels (the layout of Spark's own image source).

    ``decode`` turns one encoded image into a height x width x channel array of
    blue-green-red bytes; it runs in the tasks.  A picture it cannot read gives a
    null image and its reason in ``decode_error`` instead of failing the job.
    """
    pointed = frames.withColumns(
        {"_path": F.col("image.path"), "_offset": F.col("image.offset"), "_size": F.col("image.size")}
    )
    loaded = fetch(pointed, "_path", "_offset", "_size", "_bytes_").drop("_path", "_offset", "_size", "image")
    kind = T.StructType(
        [
            T.StructField("height", T.IntegerType()),
            T.StructField("width", T.IntegerType()),
            T.StructField("nChannels", T.IntegerType()),
            T.StructField("data", T.BinaryType()),
            T.StructField("error", T.StringType()),
        ]
    )

    @F.pandas_udf(kind)
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for encoded in batch:
                try:
                    pixels = np.ascontiguousarray(decode(bytes(encoded)))
                    rows.append((*pixels.shape, pixels.tobytes(), None))
                except Exception as error:  # one broken picture is a finding, not a failure
                    rows.append((None, None, None, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=["height", "width", "nChannels", "data", "error"])

    pixels = loaded.withColumn("_i", read("_bytes_"))
    image = F.struct(*[F.col(f"_i.{name}").alias(name) for name in ("height", "width", "nChannels", "data")])
    return pixels.withColumns(
        {"image": F.when(F.col("_i.error").isNull(), image), "decode_error": F.col("_i.error")}
    ).drop("_i", "_bytes_")


def shape_changes(frames: DataFrame, keys: Sequence[str], image: str = "image") -> DataFrame:
    """Cameras whose pictures do not all have one shape."""
    shape = F.struct(*[F.col(f"{image}.{name}") for name in ("height", "width", "nChannels")])
    per_shape = frames.filter(F.col(image).isNotNull()).groupBy(*keys, shape.alias("shape")).agg(F.count("*").alias("_c"))
    return per_shape.groupBy(*keys).agg(F.count("*").alias("shapes")).filter(F.col("shapes") > 1)
