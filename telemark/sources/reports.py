"""Report sinks: CSV, JSON lines, Markdown tables, plot data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyarrow.fs import FileType
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark.sources.mcap import open_folder


def _flat(df: DataFrame) -> DataFrame:
    """Nested values as JSON, so that every column fits a CSV cell."""
    nested = ("array", "map", "struct")
    return df.select(
        *[
            F.to_json(f"`{f.name}`").alias(f.name) if f.dataType.typeName() in nested else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


EVENT_ORDER = ("episode", "episode_index", "topic", "frame_index", "joint_index", "kind")


def in_event_order(df: DataFrame) -> DataFrame:
    """Events by stream, frame, joint and kind; files in order of their names hold them in order."""
    order = [c for c in EVENT_ORDER if c in df.columns]
    return df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df


def write_csv(df: DataFrame, path: str, *, overwrite: bool = False) -> None:
    """CSV with a header, written by as many tasks as the rows need."""
    _flat(df).write.mode("overwrite" if overwrite else "errorifexists").csv(path, header=True)


def write_json_lines(df: DataFrame, path: str, *, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def write_text(path: str, text: str) -> None:
    system, plain = open_folder(path)
    system.create_dir(plain.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(plain) as handle:
        handle.write(text.encode("utf-8"))


def markdown_table(df: DataFrame, order: Sequence[Column], rows: int = 200) -> str:
    """The first rows of a summary as a table, for people; the full data is in the CSV."""
    head = "| " + " | ".join(df.columns) + " |\n| " + " | ".join("---" for _ in df.columns) + " |\n"
    taken = df.orderBy(*order).limit(rows + 1).collect()

    def cell(value) -> str:
        return f"{value:.3f}" if isinstance(value, float) else str(value)

    lines = ["| " + " | ".join(cell(v) for v in row) + " |" for row in taken[:rows]]
    more = "\n\nFurther rows are in the CSV files.\n" if len(taken) > rows else "\n"
    return head + "\n".join(lines) + more


def histogram(df: DataFrame, keys: Sequence[str], value: Column, bins: int = 60) -> DataFrame:
    """Counts of equal-width bins between the extremes of each group: plot data."""
    rows = df.select(*keys, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    ends = rows.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    spot = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))).otherwise(0)
    binned = rows.join(ends, list(keys)).withColumns({"bin": spot.cast("bigint"), "bin_start": F.col("_lo") + spot * width})
    return binned.groupBy(*keys, "bin").agg(F.min("bin_start").alias("bin_start"), F.count("*").alias("rows"))


def new_run_folder(root: str, label: str) -> str:
    """A folder named by time and label that did not exist before."""
    stamp = datetime.now(UTC).strftime("%Y%m%dT%H%M%S%fZ")
    folder = f"{root.rstrip('/')}/{stamp}_{label.replace('/', '__').replace(' ', '_')}"
    system, plain = open_folder(folder)
    if system.get_file_info(plain).type != FileType.NotFound:
        raise FileExistsError(folder)
    system.create_dir(plain, recursive=True)
    return folder
