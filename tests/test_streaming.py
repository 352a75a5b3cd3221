from __future__ import annotations

from pyspark.sql import functions as F

from telemark.functions.sequence import carry, track
from telemark.streaming import detectors


def _run(spark, stream, name, folder):
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/{name}")
        .option("checkpointLocation", f"{folder}/{name}-state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    return spark.read.parquet(f"{folder}/{name}")


def test_streamed_detection_equals_batch(spark, tmp_path):
    rows = spark.range(60).select(
        (F.col("id") % 2).cast("string").alias("topic"),
        F.col("id").alias("place"),
        (F.col("id") * 10_000_000 + F.when(F.col("id") % 9 == 0, 90_000_000).otherwise(0)).alias("t"),
        F.array(F.when(F.col("id") % 14 < 2, 20.0).otherwise(0.0), F.col("id") * 0.1).alias("v"),
    )
    source = str(tmp_path / "in")
    for part in range(3):  # one file, one micro-batch
        rows.filter(F.floor(F.col("place") / 20) == part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)

    gaps = _run(spark, detectors.detect_gaps(stream, ["topic"], "place", "t", 50.0), "gaps", tmp_path)
    line = carry(track(rows, ["topic"], ["place"]), prev={"_t": F.col("t"), "_p": F.col("place")}).df
    step = F.col("t") - F.col("_t")
    batch = line.filter((step <= 0) | (step / 1e6 > 50)).select("topic", F.col("_p"), step)
    assert sorted(map(tuple, gaps.select("topic", "edge_after_index", "step_ns").collect())) == sorted(map(tuple, batch.collect()))
    assert gaps.count() > 0

    spikes = _run(spark, detectors.detect_spikes(stream, ["topic"], "place", "v"), "spikes", tmp_path)
    around = carry(track(rows, ["topic"], ["place"]), prev={"_a": F.col("v")[0]}, next={"_b": F.col("v")[0]}).df
    x = F.col("v")[0]
    hit = (F.abs(x - F.col("_a")) >= 5) & (F.abs(F.col("_b") - x) >= 5) & (F.abs(F.col("_b") - F.col("_a")) <= 1)
    assert sorted(map(tuple, spikes.select("topic", "place" if "place" in spikes.columns else "frame").collect())) == sorted(
        map(tuple, around.filter(hit).select("topic", "place").collect())
    )
    assert spikes.count() > 0
