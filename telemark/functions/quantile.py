"""Exact percentiles with linear interpolation, for groups of any size."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telemark.functions.sequence import fits_one_task, segment_rows, track
from telemark.sources.durable import durable

#: Rank error of the sketches (one in so many), and how far from a wanted rank its band reaches on either side.
_ACCURACY = 5000
_SLACK = 1e-3


def summarise(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column] = (),
    quantiles: Mapping[str, tuple[Column, Mapping[str, float]]] | None = None,
    *,
    bound: int | None = None,
    largest: int | None = None,
) -> DataFrame:
    """``groupBy(keys)`` with plain aggregates and exact percentiles.

    ``quantiles`` maps a value name to its column and ``{output: fraction}``.
    Null values are ignored.  The built-in ``percentile`` keeps all distinct
    values of a group in one task, so it is used only where every group is known
    to be small; larger groups go through :func:`select_ranks`.  The size is taken
    from ``largest`` if given, from ``bound`` if that is small, and counted else.
    """
    quantiles = dict(quantiles or {})
    if not quantiles:
        return df.groupBy(*keys).agg(*aggregates)
    if not keys:
        whole = df.withColumn("_all", F.lit(0))
        return summarise(whole, ["_all"], aggregates, quantiles, bound=bound, largest=largest).drop("_all")
    if largest is not None:
        small = largest <= segment_rows(df.sparkSession)
    else:
        small = fits_one_task(df, keys, bound)
    if small:
        arrays = [
            F.percentile(value.cast("double"), F.array(*[F.lit(float(q)) for q in wanted.values()])).alias(f"_q_{name}")
            for name, (value, wanted) in quantiles.items()
        ]
        grouped = df.groupBy(*keys).agg(*aggregates, *arrays)
        outputs = {
            output: F.col(f"_q_{name}")[place]
            for name, (_, wanted) in quantiles.items()
            for place, output in enumerate(wanted)
        }
        return grouped.withColumns(outputs).drop(*[f"_q_{name}" for name in quantiles])
    result = df.groupBy(*keys).agg(*(aggregates or [F.count("*").alias("_rows")]))
    for value, wanted in quantiles.values():
        ranked = select_ranks(df.select(*keys, value.cast("double").alias("_v")), keys, wanted)
        result = result.join(ranked, list(keys), "left")
    return result.drop("_rows")


def select_ranks(df: DataFrame, keys: Sequence[str], wanted: Mapping[str, float]) -> DataFrame:
    """Percentiles of ``_v`` per group by locating the ranks they fall on.

    Sketches enclose every wanted rank in a narrow band of values.  The rows below and inside each band
    are counted, so the bands are known to hold the ranks (if one does not, all bands are opened); only
    rows inside are shuffled.  There, equal values collapse first; the distinct values are cut into value
    ranges, and only the ranges that hold a wanted rank are looked at row by row.
    """
    keys = list(keys)
    values = durable(df.filter(F.col("_v").isNotNull()))
    fractions = [float(f) for f in wanted.values()]
    ends = [F.lit(min(max(f + side * _SLACK, 0.0), 1.0)) for f in fractions for side in (-1, 1)]
    sketched = values.groupBy(*keys).agg(F.count("*").alias("_n"), F.percentile_approx("_v", F.array(*ends), _ACCURACY).alias("_p"))
    bands = [(F.col("_p")[2 * k], F.col("_p")[2 * k + 1]) for k in range(len(fractions))]
    # One row a group, written so that its size is known and joins with it move nothing.
    sketched = durable(sketched)
    sides = [c for k, (low, high) in enumerate(bands) for c in (F.count_if(F.col("_v") < low).alias(f"_b{k}"), F.count_if(F.col("_v") <= high).alias(f"_u{k}"))]
    first = [F.first(c).alias(c) for c in ("_n", "_p")]
    placed = durable(values.join(sketched, keys).groupBy(*keys).agg(*first, *sides))
    ranks = [(F.floor((F.col("_n") - 1) * F.lit(f)), F.ceil((F.col("_n") - 1) * F.lit(f))) for f in fractions]
    outside = [(low < F.col(f"_b{k}")) | (high >= F.col(f"_u{k}")) for k, (low, high) in enumerate(ranks)]
    narrow = placed.filter(functools.reduce(lambda a, b: a | b, outside)).isEmpty()
    tables = [
        F.struct(
            F.lit(k).alias("_band"),
            (F.col(f"_b{k}") if narrow else F.lit(0).cast("bigint")).alias("_below"),
            F.array_distinct(F.array(*ranks[k])).alias("_spots"),
            bands[k][0].alias("_low"),
            bands[k][1].alias("_high"),
        )
        for k in range(len(fractions))
    ]
    spots = durable(placed.select(*keys, "_n", F.inline(F.array(*tables))))
    group = [*keys, "_band"]
    inside = values.join(spots.select(*group, "_low", "_high"), keys)
    if narrow:
        inside = inside.filter(F.col("_v").between(F.col("_low"), F.col("_high")))
    counted = durable(inside.groupBy(*group, "_v").agg(F.count("*").alias("_c")))
    ranges = track(counted, group, ["_v"])
    place = [*group, *ranges.segments]
    per_range = ranges.df.groupBy(*place).agg(F.sum("_c").alias("_in"))
    if ranges.segments:
        along = Window.partitionBy(*group).orderBy(*ranges.segments)
        earlier = F.coalesce(F.sum("_in").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        per_range = per_range.withColumn("_earlier", earlier)
    else:
        per_range = per_range.withColumn("_earlier", F.lit(0).cast("bigint"))
    per_range = per_range.join(spots.select(*group, "_n", "_below", "_spots"), group)
    per_range = per_range.withColumn("_before", F.col("_earlier") + F.col("_below"))
    held = F.filter("_spots", lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_in")))
    per_range = per_range.withColumn("_ranks", held).filter(F.size("_ranks") > 0).select(*place, "_n", "_before", "_ranks")
    rows = ranges.df.join(per_range, place)
    so_far = Window.partitionBy(*place).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_upto", F.col("_before") + F.sum("_c").over(so_far))
    rows = rows.withColumn(
        "_hit", F.explode(F.filter("_ranks", lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_c"))))
    )
    # At most two ranks per wanted percentile remain for a group; two bands may hold the same one.
    found = rows.groupBy(*keys).agg(
        F.max("_n").alias("_n"), F.map_from_entries(F.collect_set(F.struct("_hit", "_v"))).alias("_at")
    )
    return found.select(
        *keys, *[_interpolate(F.col("_at"), F.col("_n"), fraction).alias(name) for name, fraction in wanted.items()]
    )


def _interpolate(at: Column, n: Column, fraction: float) -> Column:
    position = (n - 1) * F.lit(float(fraction))
    low, high = F.floor(position), F.ceil(position)
    lower, upper = F.element_at(at, low), F.element_at(at, high)
    return F.when((low == high) | (lower == upper), lower).otherwise(
        (high - position) * lower + (position - low) * upper
    )
