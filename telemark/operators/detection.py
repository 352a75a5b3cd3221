"""Object detections: running a detector over frames, and the report figures."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DETECTION = "struct<label:string,confidence:double,bbox_xyxy:array<double>>"


def detect(frames: DataFrame, load: Callable[[], Callable[[pd.DataFrame], list]], columns: Sequence[str]) -> DataFrame:
    """Add ``detections`` to frames.

    ``load`` runs once per task and returns a function from a batch of frames to
    one list of detections per frame; the model itself is the caller's.
    """
    kept = frames.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + f", detections array<{DETECTION}>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = load()
        for batch in batches:
            yield batch.assign(detections=detector(batch))

    return kept.mapInPandas(run, schema)


def unfold(frames: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frames.select(*keys, F.explode("detections").alias("_d")).select(*keys, "_d.*")


def above_confidence(detections: DataFrame, limit: float) -> DataFrame:
    return detections.filter(F.col("confidence") >= limit)


def label_counts(detections: DataFrame, frame: Sequence[str]) -> DataFrame:
    """Detections per label, and the frames each label appears in.

    Counted per frame and label first: a label on a third of all boxes still
    spreads over its frames.
    """
    per_frame = detections.groupBy("label", *frame).agg(F.count("*").alias("_c"))
    return per_frame.groupBy("label").agg(F.sum("_c").alias("detections"), F.count("*").alias("frames_with_label"))


def summary(frames: DataFrame, detections: DataFrame, frame: Sequence[str]) -> DataFrame:
    hit = detections.groupBy(*frame).agg(F.count("*").alias("_c"))
    return frames.join(hit, list(frame), "left").agg(
        F.count("*").alias("frames"),
        F.count("_c").alias("frames_with_detections"),
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("detections"),
    )
