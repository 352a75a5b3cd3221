"""The given tables read as recordings: streams, camera clocks, joint frames, pictures.

Every relation here has a twin in SQL (the ``*_SQL`` strings), so each query can
be checked on the same tables by another engine.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemark.functions.sequence import Track, carry, floor_div, track
from telemark.functions.scalar import primary_time
from telemark.operators.exposure import luminance

FRAME_NS = 33_333_000
#: Embeddings have 64 values: so many joints of one frame, or two robots of fourteen joints and two grippers.
JOINTS = 64
ARMS = 14
ROBOT_VALUES = 32


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> T.StructType:
    """Inferring a schema opens files; once per table is enough."""
    return spark.read.parquet(path).schema


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


@lru_cache(maxsize=64)
def row_count(spark: SparkSession, folder: str, name: str) -> int:
    """Table size from the file footers; an upper bound for any group in it."""
    return read(spark, folder, name).count()


def stamp_ns(ts: str) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(ts)) * F.lit(1000).cast("bigint")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages: five topics, with missing and frozen header stamps."""
    events = read(spark, folder, "events").withColumn("pub_ns", stamp_ns("ts"))
    key, pub = F.col("event_id"), F.col("pub_ns")
    hours = 7_200_000_000_000
    header = F.when(key % 101 == 0, F.lit(None)).when(key % 50 < 10, floor_div(pub, hours) * hours).otherwise(pub)
    return events.select(
        F.year("ts").cast("string").alias("episode"),
        F.col("event_type").alias("topic"),
        key.alias("record_index"),
        "user_id",
        "value",
        "pub_ns",
        F.when(key % 103 == 0, F.lit(0).cast("bigint")).otherwise(pub).alias("publish_time_ns"),
        (pub + key % 7 * 1_000_000).alias("log_time_ns"),
        header.cast("bigint").alias("header_time_ns"),
    )


MESSAGES_SQL = """
msg AS (
  SELECT year(ts)::VARCHAR AS episode, event_type AS topic, event_id AS record_index, user_id, value, pub AS pub_ns,
         CASE WHEN event_id % 103 = 0 THEN 0 ELSE pub END AS publish_time_ns,
         pub + (event_id % 7) * 1000000 AS log_time_ns,
         CASE WHEN event_id % 101 = 0 THEN NULL
              WHEN event_id % 50 < 10 THEN (pub // 7200000000000) * 7200000000000 ELSE pub END AS header_time_ns
  FROM (SELECT *, epoch_us(ts) * 1000 AS pub FROM events)),
stream AS (
  SELECT *, coalesce(header_time_ns, CASE WHEN publish_time_ns > 0 THEN publish_time_ns END, log_time_ns) AS time_ns,
         row_number() OVER (PARTITION BY topic ORDER BY record_index) - 1 AS topic_index
  FROM msg),
edges AS (
  SELECT *, time_ns - lag(time_ns) OVER (PARTITION BY topic ORDER BY record_index) AS step_ns,
         (time_ns - lag(time_ns) OVER (PARTITION BY topic ORDER BY record_index)) / 1e6 AS dt_ms
  FROM stream)"""


def stream(spark: SparkSession, folder: str, time: str | None = None, *, numbered: bool = True) -> Track:
    """Messages per topic in record order; ``time_ns`` is the acquisition time."""
    rows = messages(spark, folder).withColumn("time_ns", F.col(time) if time else primary_time())
    line = track(rows, ["topic"], ["record_index"], bound=row_count(spark, folder, "events"))
    return carry(line, number="topic_index") if numbered else line


def camera(spark: SparkSession, folder: str) -> Track:
    """A 30 Hz camera clock per topic with freezes, back jumps and offset stretches."""
    rows = read(spark, folder, "events").select(F.col("event_type").alias("topic"), F.col("event_id").alias("record_index"))
    line = track(rows, ["topic"], ["record_index"], bound=row_count(spark, folder, "events"))
    line = carry(line, number="fr")
    fr = F.col("fr")
    base = fr * FRAME_NS + ((F.col("record_index") * 7919) % 2001 - 1000) * 1000
    header = (
        F.when((fr % 97).isin(40, 41, 42), (fr - fr % 97 + 39) * FRAME_NS + 250_000)
        .when(fr % 151 == 75, base - 100_000_000)
        .when((fr > 211) & (fr % 211 >= 200), base + 70_000_000)
        .otherwise(base)
    )
    return line.derive({"header_ns": header})


CAMERA_SQL = """
cam0 AS (
  SELECT event_type AS topic, event_id AS record_index,
         row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS fr FROM events),
cam1 AS (SELECT *, fr * 33333000 + ((record_index * 7919) % 2001 - 1000) * 1000 AS base FROM cam0),
cam AS (
  SELECT topic, record_index, fr,
         CASE WHEN fr % 97 IN (40, 41, 42) THEN (fr - fr % 97 + 39) * 33333000 + 250000
              WHEN fr % 151 = 75 THEN base - 100000000
              WHEN fr > 211 AND fr % 211 >= 200 THEN base + 70000000 ELSE base END AS header_ns
  FROM cam1),
cedge AS (SELECT *, header_ns - lag(header_ns) OVER (PARTITION BY topic ORDER BY fr) AS step_ns FROM cam)"""


def joint_frames(spark: SparkSession, folder: str) -> Track:
    """Embeddings as joint vectors: one episode per label, 20 frames a second."""
    rows = read(spark, folder, "embeddings").select(
        F.col("label").alias("episode"),
        "vec_id",
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    line = track(rows, ["episode"], ["vec_id"], bound=row_count(spark, folder, "embeddings"))
    line = carry(line, number="frame")
    return line.derive(
        {
            "values": F.slice("vector", 1, JOINTS),
            "degrees": F.transform(F.slice("vector", 1, JOINTS), lambda x: F.degrees(x)),
            "time_s": F.col("frame") / F.lit(20.0),
            "time_ns": F.col("frame") * F.lit(50_000_000),
        }
    )


JOINTS_SQL = """
frames AS (
  SELECT label AS episode, vec_id, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame
  FROM embeddings),
cell0 AS (
  SELECT episode, frame, frame / 20.0::DOUBLE AS t, j - 1 AS joint, embedding[j]::DOUBLE AS v
  FROM frames, generate_series(1, 64) g(j)),
cell AS (
  SELECT *, lag(v) OVER w AS v1, lag(v, 2) OVER w AS v2, lead(v) OVER w AS vn, lag(t) OVER w AS t1, lag(t, 2) OVER w AS t2
  FROM cell0 WINDOW w AS (PARTITION BY episode, joint ORDER BY frame)),
kin AS (
  SELECT *, degrees(abs(v - v1)) AS step_deg, degrees(abs((v - v1) / (t - t1))) AS velocity_deg_s,
         degrees(abs(((v - v1) / (t - t1) - (v1 - v2) / (t1 - t2)) / (((t1 - t2) + (t - t1)) / 2.0))) AS acceleration_deg_s2,
         CASE WHEN vn IS NOT NULL THEN degrees(abs(v - v1)) END AS entry_deg,
         CASE WHEN v1 IS NOT NULL THEN degrees(abs(vn - v)) END AS exit_deg, degrees(abs(vn - v1)) AS recovery_deg
  FROM cell)"""


def robot_frames(spark: SparkSession, folder: str) -> Track:
    """Converted frames: single-precision state and action of sixteen dimensions."""
    rows = read(spark, folder, "embeddings").select(
        F.col("label").cast("string").alias("label"),
        "vec_id",
        F.explode(F.array(F.lit(0), F.lit(1))).alias("robot"),
        F.col("embedding").cast("array<double>").alias("all"),
    )
    rows = rows.select(
        F.concat_ws("-", "label", "robot").alias("episode"),
        "vec_id",
        F.slice("all", F.col("robot") * ROBOT_VALUES + 1, F.lit(ROBOT_VALUES)).alias("vector"),
    )
    frames = carry(track(rows, ["episode"], ["vec_id"], bound=row_count(spark, folder, "embeddings")), number="frame")
    frames = frames.derive({"time_s": F.col("frame") / F.lit(20.0), "time_ns": F.col("frame") * F.lit(50_000_000)})

    def number(i):
        return F.get(F.col("vector"), F.lit(i))

    state = F.array(*[number(i) for i in range(ARMS)], *[_grip(number(i)) for i in (28, 29)])
    action = F.array(
        *[number(i) + number(i + ARMS) * 0.1 for i in range(ARMS)], *[_grip(number(i)) for i in (30, 31)]
    )
    single = T.ArrayType(T.FloatType())
    return frames.derive({"state": state.cast(single), "action": action.cast(single)})


def _grip(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x * 50.0 / 100.0 + 0.5))


ROBOT_SQL = """
frames AS (
  SELECT label::VARCHAR || '-' || r AS episode, vec_id, embedding[r * 32 + 1:r * 32 + 32] AS embedding,
         row_number() OVER (PARTITION BY label, r ORDER BY vec_id) - 1 AS frame
  FROM embeddings, generate_series(0, 1) two(r)),
robot AS (
  SELECT episode, frame, d - 1 AS dimension,
    CASE WHEN d <= 14 THEN embedding[d]::DOUBLE
         ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, embedding[d + 14]::DOUBLE * 50.0::DOUBLE / 100.0::DOUBLE + 0.5::DOUBLE)) END::FLOAT AS state,
    CASE WHEN d <= 14 THEN embedding[d]::DOUBLE + embedding[d + 14]::DOUBLE * 0.1::DOUBLE
         ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, embedding[d + 16]::DOUBLE * 50.0::DOUBLE / 100.0::DOUBLE + 0.5::DOUBLE)) END::FLOAT AS action
  FROM frames, generate_series(1, 16) g(d))"""


def pictures(spark: SparkSession, folder: str) -> Track:
    """Embeddings as 22-pixel colour frames of one camera per label; the last pixel repeats the last value."""
    rows = read(spark, folder, "embeddings").select(
        F.col("label").alias("camera"), "vec_id", F.col("embedding").cast("array<double>").alias("e")
    )
    line = track(rows, ["camera"], ["vec_id"], bound=row_count(spark, folder, "embeddings"))
    line = carry(line, number="frame_index")
    return line.derive({"light": light("e")})


def light(vector: str) -> Column:
    """Luminances of the 22 pixels whose colours a vector of 64 values holds."""

    def code(i: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.get(F.col(vector), F.least(i, F.lit(63))) * 1.2 + 0.80))

    spots = F.sequence(F.lit(0), F.lit(21))
    return F.transform(spots, lambda i: luminance(code(i * 3), code(i * 3 + 1), code(i * 3 + 2)))


PICTURES_SQL = """
shots AS (
  SELECT label AS camera, vec_id, embedding AS e, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index
  FROM embeddings),
codes AS (
  SELECT camera, frame_index, p, c, greatest(0.0::DOUBLE, least(1.0::DOUBLE, e[least(p * 3 + c, 63) + 1]::DOUBLE * 1.2::DOUBLE + 0.80::DOUBLE)) AS code
  FROM shots, generate_series(0, 21) g(p), generate_series(0, 2) h(c)),
lin AS (
  SELECT camera, frame_index, p, c, CASE WHEN code <= 0.04045::DOUBLE THEN code / 12.92::DOUBLE
         ELSE pow((code + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) END AS y FROM codes),
px AS (
  SELECT camera, frame_index, p, sum(CASE c WHEN 0 THEN 0.2126::DOUBLE * y WHEN 1 THEN 0.7152::DOUBLE * y ELSE 0.0722::DOUBLE * y END) AS y
  FROM lin GROUP BY ALL),
shot AS (
  SELECT camera, frame_index, quantile_cont(y, 0.5) AS l50, quantile_cont(y, 0.95) AS l95,
         count(*) FILTER (y > 0.98) / count(*)::DOUBLE AS highlight_clipping_ratio
  FROM px GROUP BY ALL),
flagged AS (
  SELECT *, l50 >= 0.40 AND l95 >= 0.90 AS broad_overexposure_candidate,
         highlight_clipping_ratio >= 0.05 AS highlight_clipping_candidate,
         (l50 >= 0.40 AND l95 >= 0.90) OR highlight_clipping_ratio >= 0.05 AS candidate FROM shot),
marked AS (
  SELECT *, CASE WHEN candidate THEN frame_index - row_number() OVER (PARTITION BY camera, candidate ORDER BY frame_index) END AS run
  FROM flagged),
judged AS (
  SELECT *, coalesce(candidate AND count(*) OVER (PARTITION BY camera, run) >= 3, false) AS confirmed FROM marked)"""


def settle(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round real numbers for a comparison across engines."""
    rounded = [
        F.round(F.col(f.name).cast("double"), digits).alias(f.name)
        if isinstance(f.dataType, T.DoubleType | T.FloatType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*rounded)
