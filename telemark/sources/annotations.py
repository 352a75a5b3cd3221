"""Per-episode settings from a JSON object of objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemark.sources.dataset import read_json

FIELDS = "episode string, include boolean, task string, start_time_s double, end_time_s double, success boolean, failure_reason string, notes string"
_KNOWN = {"include", "task", "start_time_s", "end_time_s", "success", "failure_reason", "notes"}


def read_annotations(spark: SparkSession, path: str | None) -> DataFrame:
    """One row per annotated episode; absent settings are null."""
    document = {} if path is None else read_json(path)
    if not isinstance(document, dict) or not all(isinstance(v, dict) for v in document.values()):
        raise ValueError("annotations are a JSON object that maps episode names to objects")
    rows = []
    for name, given in document.items():
        unknown = set(given) - _KNOWN
        if unknown:
            raise ValueError(f"unknown settings for {name}: {sorted(unknown)}")
        numbers = [None if given.get(k) is None else float(given[k]) for k in ("start_time_s", "end_time_s")]
        rows.append((name, given.get("include"), given.get("task"), *numbers, given.get("success"), given.get("failure_reason"), given.get("notes")))
    return spark.createDataFrame(rows, FIELDS)
