"""Episodes: discovery, required topics, annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark.sources.mcap import find_episodes, open_folder


def missing_topics(messages: DataFrame, episode: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Required topics an episode does not carry.

    The topics seen are folded to a set no larger than the list of requirements.
    """
    wanted = F.array(*[F.lit(name) for name in required])
    seen = messages.groupBy(*episode).agg(
        F.collect_set(F.when(F.col("topic").isin(*required), F.col("topic"))).alias("_seen")
    )
    return seen.select(*episode, F.explode(F.array_except(wanted, F.col("_seen"))).alias("topic"))


def file_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Size and change time of every recording: names and numbers only, no content."""
    rows = []
    for episode, path, _number, size in find_episodes(root):
        system, plain = open_folder(path)
        rows.append((episode, path, size, system.get_file_info(plain).mtime_ns))
    return spark.createDataFrame(rows, "episode string, path string, size bigint, mtime_ns bigint")


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Recordings that were changed, added or removed between two snapshots."""
    old = before.select("path", F.struct("size", "mtime_ns").alias("old"))
    new = after.select("path", F.struct("size", "mtime_ns").alias("new"))
    return old.join(new, "path", "full").filter(~F.col("old").eqNullSafe(F.col("new"))).select("path")
