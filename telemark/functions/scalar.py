"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemark import contract


def to_ms(ns: Column) -> Column:
    return ns / F.lit(1e6)


def to_seconds(ns: Column) -> Column:
    return ns / F.lit(1e9)


def nearest_integer(value: Column) -> Column:
    """Round half to even."""
    return F.rint(value).cast("bigint")


def primary_time(header: str = "header_time_ns", publish: str = "publish_time_ns", log: str = "log_time_ns") -> Column:
    """Acquisition time: header, else a positive publish time, else log time."""
    published = F.when(F.col(publish) > 0, F.col(publish))
    return F.coalesce(F.col(header), published, F.col(log))


def topic_category(topic: Column) -> Column:
    return (
        F.when(topic.isin(*contract.IMAGE_TOPICS), "image")
        .when(topic.isin(*contract.ACTION_TOPICS), "action")
        .otherwise("state")
    )


def slug(text: Column, default: str = "stream") -> Column:
    words = F.btrim(F.regexp_replace(text, "[^a-zA-Z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(F.lower(words), F.lit("")), F.lit(default))


def safe_name(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, "[^A-Za-z0-9_-]+", "_"), F.lit("_"))


def canonical_joint(name: Column) -> Column:
    """One spelling for ``arm_L_joint3`` and ``arm_l_j3``."""
    return F.regexp_replace(F.lower(name), "^arm_([lr])_j(?:oint)?([1-7])$", "arm_$1_joint$2")


def episode_number(name: Column, otherwise: Column) -> Column:
    """The number in ``episode_000012``, or the fallback ordinal."""
    digits = F.nullif(F.regexp_extract(name, "^episode_(\\d+)$", 1), F.lit(""))
    return F.coalesce(digits.try_cast("bigint"), otherwise)


def is_infinite(value: Column) -> Column:
    return F.abs(value) == F.lit(float("inf"))


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & ~is_infinite(value)


def split_time(ns: Column) -> tuple[Column, Column]:
    """Seconds and the non-negative nanosecond remainder."""
    nanos = F.pmod(ns, F.lit(1_000_000_000).cast("bigint"))
    return F.call_function("div", ns - nanos, F.lit(1_000_000_000).cast("bigint")), nanos


def join_time(seconds: Column, nanos: Column) -> Column:
    return seconds.cast("bigint") * F.lit(1_000_000_000).cast("bigint") + nanos.cast("bigint")


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def named_values(required: list[str] | tuple[str, ...], names: str = "names", values: str = "values") -> Column:
    """Values picked by name, in the order asked for; null where a name is missing."""
    picks = [F.get(F.col(values), (F.array_position(F.col(names), name) - 1).cast("int")) for name in required]
    return F.array(*picks)


def columns_with_prefix(prefix: str, names: str = "names", values: str = "values") -> Column:
    pairs = F.arrays_zip(F.col(names).alias("name"), F.col(values).alias("value"))
    return F.transform(F.filter(pairs, lambda p: p["name"].startswith(prefix)), lambda p: p["value"])


def linear_light(code: Column) -> Column:
    """sRGB sample in [0, 1] to linear light."""
    return F.when(code <= 0.04045, code / 12.92).otherwise(F.pow((code + 0.055) / 1.055, F.lit(2.4)))


def array_percentile(sorted_values: Column, fraction: float) -> Column:
    """Linear-interpolated percentile of an ascending array."""
    position = (F.size(sorted_values) - 1) * F.lit(float(fraction))
    low = F.floor(position).cast("int")
    lower, upper = F.get(sorted_values, low), F.get(sorted_values, F.ceil(position).cast("int"))
    return lower + (upper - lower) * (position - low)


def label_for(index: Column, names: Column) -> Column:
    """Detection label from an index → name map, or the index itself."""
    return F.coalesce(F.try_element_at(names, index), index.cast("string"))
