"""Training datasets: Parquet files per episode with JSON metadata."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark import contract
from telemark.functions.sequence import carry, numbered, track
from telemark.sources.mcap import fetch, open_folder

CHUNK_SIZE = 1000
VECTORS = ("observation.state", "action")
FEATURE_NAMES = {
    "observation.state": [*contract.FOLLOWER_JOINT_NAMES, "left_gripper", "right_gripper"],
    "action": [*contract.LEADER_JOINT_NAMES, "left_gripper", "right_gripper"],
}


def numbered_episodes(frames: DataFrame) -> DataFrame:
    """Consecutive ``episode_index`` by name.  One row per episode."""
    names = frames.groupBy("episode").agg(F.count("*").alias("length"))
    return numbered(names, ["episode"], "episode_index")


def write_dataset(
    frames: DataFrame,
    root: str,
    *,
    fps: float,
    tasks: DataFrame | None = None,
    with_images: bool = True,
    overwrite: bool = False,
    robot_type: str = "dual_arm",
) -> DataFrame:
    """Write frames of planned episodes; returns the episode table.

    Image pointers become image bytes here, after everything has been selected.
    Partitions follow the chunk and episode folders of the layout, so an episode
    is one directory and readers prune by it.
    """
    episodes = numbered_episodes(frames)
    if tasks is not None:
        episodes = episodes.join(tasks.select("episode", "task"), "episode", "left")
    else:
        episodes = episodes.withColumn("task", F.lit(None).cast("string"))
    rows = frames.join(episodes.select("episode", "episode_index"), "episode")
    rows = rows.withColumn("episode_chunk", F.call_function("div", F.col("episode_index"), F.lit(CHUNK_SIZE).cast("bigint")))
    for feature in contract.IMAGE_FEATURES:
        if feature not in frames.columns:
            continue
        if not with_images:
            rows = rows.drop(feature)
            continue
        pointer = F.col(f"`{feature}`")
        rows = rows.withColumns({"_path": pointer["path"], "_offset": pointer["offset"], "_size": pointer["size"]})
        rows = fetch(rows.drop(feature), "_path", "_offset", "_size", feature).drop("_path", "_offset", "_size")
    columns = [c for c in rows.columns if c != "episode"]
    # Frame ranges keep one very long episode from being written by a single task.
    block = F.call_function("div", F.col("frame_index"), F.lit(100_000).cast("bigint"))
    placed = rows.select(*[F.col(f"`{c}`") for c in columns]).repartition("episode_index", block)
    placed = placed.sortWithinPartitions("episode_chunk", "episode_index", "frame_index")
    writer = placed.write.mode("overwrite" if overwrite else "errorifexists")
    writer.partitionBy("episode_chunk", "episode_index").parquet(f"{root}/data")
    episodes.write.mode("overwrite" if overwrite else "errorifexists").json(f"{root}/meta/episodes")
    totals = episodes.agg(F.count("*"), F.sum("length")).first()
    write_json(
        f"{root}/meta/info.json",
        {
            "fps": fps,
            "robot_type": robot_type,
            "chunks_size": CHUNK_SIZE,
            "total_episodes": totals[0],
            "total_frames": totals[1] or 0,
            "data_path": "data/episode_chunk={chunk}/episode_index={episode}",
            "features": {
                name: {"dtype": "float32", "shape": [len(names)], "names": [names]} for name, names in FEATURE_NAMES.items()
            },
        },
    )
    return episodes


def write_json(path: str, document: Mapping) -> None:
    system, plain = open_folder(path)
    system.create_dir(plain.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(plain) as handle:
        handle.write(json.dumps(document, indent=2, ensure_ascii=False, allow_nan=False).encode("utf-8"))


def read_json(path: str) -> dict:
    system, plain = open_folder(path)
    with system.open_input_stream(plain) as handle:
        return json.loads(handle.read())


def feature_names(info: Mapping, key: str, width: int) -> list[str]:
    """Names of a vector feature; nested lists are unwrapped, missing ones numbered."""
    names = (info.get("features", {}).get(key) or {}).get("names")
    while isinstance(names, list) and len(names) == 1 and isinstance(names[0], list):
        names = names[0]
    return list(names) if names else [f"{key}[{i}]" for i in range(width)]


def read_episodes(spark: SparkSession, root: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """The episode table; an episode asked for but not listed is an error."""
    episodes = spark.read.json(f"{root}/meta/episodes")
    if wanted is None:
        return episodes
    asked = spark.createDataFrame([(int(i),) for i in wanted], "episode_index bigint")
    absent = [r[0] for r in asked.join(episodes, "episode_index", "left_anti").collect()]
    if absent:
        raise ValueError(f"episodes not in the dataset: {sorted(absent)}")
    return episodes.join(F.broadcast(asked), "episode_index")


def read_frames(
    spark: SparkSession, root: str, keys: Sequence[str] = VECTORS, episodes: Sequence[int] | None = None, max_frames: int | None = None
) -> DataFrame:
    """Frames with only the columns asked for; episodes prune directories."""
    rows = spark.read.parquet(f"{root}/data").select(
        "episode_index", "frame_index", "timestamp", *[F.col(f"`{k}`") for k in keys]
    )
    if episodes is not None:
        rows = rows.filter(F.col("episode_index").isin(*episodes))
    if max_frames is not None:
        rows = rows.filter(F.col("frame_index") < max_frames)
    return rows


def broken_episodes(frames: DataFrame) -> DataFrame:
    """Episodes whose frames are not 0..n-1 or whose clock does not advance."""
    line = carry(track(frames.select("episode_index", "frame_index", "timestamp"), ["episode_index"], ["frame_index"]), prev={"_f": F.col("frame_index"), "_t": F.col("timestamp")})
    counted = line.df.groupBy("episode_index").agg(
        F.count_if(F.col("frame_index") != F.coalesce(F.col("_f") + 1, F.lit(0))).alias("index_faults"),
        F.count_if(F.col("timestamp") <= F.col("_t")).alias("clock_faults"),
    )
    return counted.filter((F.col("index_faults") > 0) | (F.col("clock_faults") > 0))
