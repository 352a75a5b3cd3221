"""Neighbour, fill and running functions over ordered groups of any size.

A window over one group runs in one task.  That is right for an ordinary
recording and wrong for a group that holds a third of a very large table, so a
``Track`` knows how its groups are laid out:

* every group is small (the size is checked, or the caller passes a proven
  bound): plain windows, one shuffle;
* some group is large: rows are cut into order-preserving segments of roughly
  ``telemark.segmentRows`` rows.  Windows run per segment, and the few values a
  segment needs from its neighbours travel through a per-segment summary that
  is smaller than the data by the segment size.

Both layouts return the same rows.
"""

from __future__ import annotations

import functools
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from telemark.sources.durable import durable

DEFAULT_SEGMENT_ROWS = 1_000_000
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def segment_rows(spark: SparkSession) -> int:
    """Largest number of rows of one group that a single task should order."""
    return int(spark.conf.get("telemark.segmentRows", str(DEFAULT_SEGMENT_ROWS)))


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest group; one aggregation over the key columns."""
    row = df.groupBy(*keys).count().agg(F.max("count")).first()
    return int(row[0] or 0)


def fits_one_task(df: DataFrame, keys: Sequence[str], bound: int | None = None) -> bool:
    limit = segment_rows(df.sparkSession)
    if bound is not None and bound <= limit:
        return True
    return largest_group(df, keys) <= limit


def floor_div(value: Column, divisor: Column | int) -> Column:
    """Exact floor division of integers (``div`` truncates toward zero)."""
    divisor = divisor if isinstance(divisor, Column) else F.lit(divisor).cast("bigint")
    return F.call_function("div", value - F.pmod(value, divisor), divisor)


@dataclass(frozen=True)
class Track:
    """Rows in groups ``keys``, ordered inside a group by ``order`` (unique there)."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    segments: tuple[str, ...] = ()
    looked: bool = False
    largest: int | None = None  # rows of the largest group, or a proven bound

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, *self.segments).orderBy(*self.order)

    @property
    def reverse(self) -> WindowSpec:
        descending = [F.col(name).desc() for name in self.order]
        return Window.partitionBy(*self.keys, *self.segments).orderBy(*descending)

    @property
    def position(self) -> Column:
        return F.col(self.order[0]) if len(self.order) == 1 else F.struct(*self.order)

    def derive(self, columns: Mapping[str, Column]) -> Track:
        return replace(self, df=self.df.withColumns(dict(columns)))

    def rows(self) -> DataFrame:
        return self.df.drop(*self.segments)


def track(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, bound: int | None = None
) -> Track:
    """Lay out ``df`` as a track; ``bound`` is a known upper limit of a group's size."""
    keys, order = tuple(keys), tuple(order)
    limit = segment_rows(df.sparkSession)
    largest = bound if bound is not None and bound <= limit else largest_group(df, keys)
    if largest <= limit:
        return Track(df, keys, order, largest=largest)
    return replace(_cut(df, keys, order, limit), largest=largest)


def kept(source: Track) -> Track:
    """The track, written once if it has segments: passes over it then read a table instead of looking along it anew."""
    return replace(source, df=durable(source.df), looked=False) if source.segments else source


def _slot(value: Column, low: Column, high: Column, parts: Column, integral: bool) -> Column:
    if integral:
        width = F.call_function("div", high - low, parts) + F.lit(1).cast("bigint")
        return F.call_function("div", value - low, width)
    width = (high - low) / parts
    slot = F.floor((value - low) / F.nullif(width, F.lit(0.0)))
    return F.coalesce(F.least(slot, parts - 1), F.lit(0).cast("bigint"))


def _cut(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], rows: int) -> Track:
    """Split groups into segments by value of the order columns.

    The first level divides the whole range evenly.  A segment that is still too
    full (a burst, or one stray value that stretched the range) is divided again
    inside its own range, by the second order column once the first is constant,
    until all fit or the rows of a full one share one place in the order.
    """
    integral = {name: isinstance(df.schema[name].dataType, _INTEGRAL) for name in order}
    lead = order[0]
    total, low, high = df.agg(F.count("*"), F.min(lead), F.max(lead)).first()
    parts = F.lit(total // rows + 1).cast("bigint")
    first = _slot(F.col(lead), F.lit(low), F.lit(high), parts, integral[lead])
    df = df.withColumn("_seg0", first)
    names = ["_seg0"]
    for level in count(1):
        spread = [F.min(c).alias(f"_lo_{c}") for c in order] + [F.max(c).alias(f"_hi_{c}") for c in order]
        sizes = df.groupBy(*keys, *names).agg(F.count("*").alias("_n"), *spread)
        over = F.col("_n") > 4 * rows
        apart = functools.reduce(lambda a, b: a | b, [F.col(f"_lo_{c}") < F.col(f"_hi_{c}") for c in order])
        crowded, divisible = sizes.agg(F.count_if(over), F.count_if(over & apart)).first()
        if not divisible:
            if crowded:
                warnings.warn(f"{crowded} segments of more than {4 * rows} rows share one place in the order {order}", stacklevel=3)
            break
        # At most total/rows groups can be over the limit, so this side is small.
        full = F.broadcast(
            sizes.filter(F.col("_n") > rows).withColumn(
                "_parts", F.call_function("div", F.col("_n"), F.lit(rows).cast("bigint")) + F.lit(1).cast("bigint")
            )
        )
        slot = F.lit(0).cast("bigint")
        for name in reversed(order):
            lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
            slot = F.when(lo < hi, _slot(F.col(name), lo, hi, F.col("_parts"), integral[name])).otherwise(slot)
        added = f"_seg{level}"
        df = (
            df.join(full, [*keys, *names], "left")
            .withColumn(added, F.coalesce(slot, F.lit(0).cast("bigint")))
            .drop("_n", "_parts", *[f"_lo_{c}" for c in order], *[f"_hi_{c}" for c in order])
        )
        names.append(added)
    return Track(df, keys, order, tuple(names))


def carry(
    source: Track,
    *,
    prev: Mapping[str, Column] | None = None,
    prev2: Mapping[str, Column] | None = None,
    next: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
    first: Mapping[str, Column] | None = None,
    running: Mapping[str, Column] | None = None,
    number: str | None = None,
) -> Track:
    """Add columns that look along the group.

    ``prev``/``prev2``/``next``: the value one row back, two rows back, one row on.
    ``last``/``first``: the last non-null value so far, the first from here on.
    ``running``: inclusive running sum.  ``number``: zero-based row number.
    """
    prev, prev2, next = dict(prev or {}), dict(prev2 or {}), dict(next or {})
    last, first, running = dict(last or {}), dict(first or {}), dict(running or {})
    if source.segments:
        if source.looked:
            # Rows and summary both read their input; without a cut, a chain of
            # looks would sort the same data twice as often with every link.
            source = replace(source, df=durable(source.df))
        source, reach = _with_summary(source, prev, prev2, next, last, first, running, number)
    else:
        reach = {}

    window, reverse = source.window, source.reverse
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = reverse.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    anchor = F.col(source.order[0])
    added: dict[str, Column] = {}
    for name, value in prev.items():
        inside = F.lag(value).over(window)
        added[name] = _edge(F.lag(anchor).over(window), inside, reach.get(name))
    for name, value in prev2.items():
        inside = F.lag(value, 2).over(window)
        if name in reach:
            second = F.when(F.lag(anchor).over(window).isNull(), reach[name]).otherwise(F.col(f"_in_{name}_1"))
            inside = F.when(F.lag(anchor, 2).over(window).isNull(), second).otherwise(inside)
        added[name] = inside
    for name, value in next.items():
        inside = F.lead(value).over(window)
        added[name] = _edge(F.lead(anchor).over(window), inside, reach.get(name))
    for name, value in last.items():
        inside = F.last(value, ignorenulls=True).over(so_far)
        added[name] = F.coalesce(inside, reach[name]) if name in reach else inside
    for name, value in first.items():
        # A reversed frame: "current row to the end" is quadratic in Spark.
        inside = F.last(value, ignorenulls=True).over(from_here)
        added[name] = F.coalesce(inside, reach[name]) if name in reach else inside
    for name, value in running.items():
        inside = F.sum(value).over(so_far)
        added[name] = inside + reach[name] if name in reach else inside
    if number:
        inside = (F.row_number().over(window) - 1).cast("bigint")
        added[number] = inside + reach[number] if number in reach else inside
    df = source.df.withColumns(added).drop(*[f"_in_{name}" for name in reach], *[f"_in_{name}_1" for name in prev2])
    return replace(source, df=df, looked=True)


def _edge(neighbour: Column, inside: Column, outside: Column | None) -> Column:
    return inside if outside is None else F.when(neighbour.isNull(), outside).otherwise(inside)


def _with_summary(source, prev, prev2, next, last, first, running, number):
    """Join each segment with what it needs from the segments around it."""
    at = source.position
    totals: list[Column] = []
    if prev2:
        # The last two rows of a segment: the last one also knows the one before.
        source = source.derive({f"_hop_{name}": F.lag(value).over(source.window) for name, value in prev2.items()})
        totals.append(F.count("*").alias("_rows"))
        for name, value in prev2.items():
            totals.append(F.max_by(value, at).alias(f"_in_{name}_1"))
            totals.append(F.max_by(F.col(f"_hop_{name}"), at).alias(f"_in_{name}"))
    for name, value in {**prev}.items():
        totals.append(F.max_by(value, at).alias(f"_in_{name}"))
    for name, value in next.items():
        totals.append(F.min_by(value, at).alias(f"_in_{name}"))
    for name, value in last.items():
        totals.append(F.max_by(value, F.when(value.isNotNull(), at)).alias(f"_in_{name}"))
    for name, value in first.items():
        totals.append(F.min_by(value, F.when(value.isNotNull(), at)).alias(f"_in_{name}"))
    for name, value in running.items():
        totals.append(F.sum(value).alias(f"_in_{name}"))
    if number:
        totals.append(F.count("*").alias(f"_in_{number}"))
    place = [*source.keys, *source.segments]
    ahead = Window.partitionBy(*source.keys).orderBy(*source.segments)
    behind = Window.partitionBy(*source.keys).orderBy(*[F.col(c).desc() for c in source.segments])
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    after = behind.rowsBetween(Window.unboundedPreceding, -1)
    shifted: dict[str, Column] = {}
    for name in prev:
        shifted[name] = F.lag(f"_in_{name}").over(ahead)
    for name in prev2:
        nearest = F.col(f"_in_{name}_1")
        two = F.lag("_rows").over(ahead) >= 2
        shifted[name] = F.when(two, F.lag(f"_in_{name}").over(ahead)).otherwise(F.lag(nearest, 2).over(ahead))
        shifted[f"{name}_1"] = F.lag(nearest).over(ahead)
    for name in next:
        shifted[name] = F.lead(f"_in_{name}").over(ahead)
    for name in last:
        shifted[name] = F.last(f"_in_{name}", ignorenulls=True).over(before)
    for name in first:
        shifted[name] = F.last(f"_in_{name}", ignorenulls=True).over(after)
    for name in [*running, *([number] if number else [])]:
        total = F.sum(f"_in_{name}").over(before)
        shifted[name] = F.coalesce(total, F.lit(0))
    summary = source.df.groupBy(*place).agg(*totals)
    summary = summary.select(*place, *[value.alias(f"_in_{name}") for name, value in shifted.items()])
    joined = source.df.drop(*[f"_hop_{name}" for name in prev2]).join(summary, place)
    return replace(source, df=joined), {name: F.col(f"_in_{name}") for name in shifted}


def islands(source: Track, flag: Column, index: str, island: str = "island") -> Track:
    """Number maximal runs of flagged rows with consecutive ``index``.

    Rows outside a run get a null island; the numbers grow along the group.
    """
    marked = _edges(source, flag, index)
    marked = carry(marked, running={"_nth": F.col("_open").cast("bigint")})
    marked = marked.derive({island: F.when(F.col("_flag"), F.col("_nth"))})
    return replace(marked, df=marked.df.drop("_flag", "_open", "_close", "_nth"))


def run_extent(
    source: Track,
    flag: Column,
    index: str,
    first: str = "run_first",
    last: str = "run_last",
    *,
    at_first: Mapping[str, Column] | None = None,
    at_last: Mapping[str, Column] | None = None,
) -> Track:
    """On every flagged row: the first and last ``index`` of the run it belongs to.

    ``at_first``/``at_last`` bring values from the two ends of the run.  Nothing is
    joined, so rows outside runs do not pile up under a null key.
    """
    at_first, at_last = dict(at_first or {}), dict(at_last or {})
    opening = F.struct(F.col(index).alias("i"), *[v.alias(n) for n, v in at_first.items()])
    closing = F.struct(F.col(index).alias("i"), *[v.alias(n) for n, v in at_last.items()])
    marked = carry(
        _edges(source, flag, index),
        last={"_start": F.when(F.col("_open"), opening)},
        first={"_end": F.when(F.col("_close"), closing)},
    )
    inside = F.col("_flag")
    found = {first: F.col("_start.i"), last: F.col("_end.i")}
    found |= {n: F.col("_start")[n] for n in at_first} | {n: F.col("_end")[n] for n in at_last}
    marked = marked.derive({name: F.when(inside, value) for name, value in found.items()})
    return replace(marked, df=marked.df.drop("_flag", "_open", "_close", "_start", "_end"))


def _edges(source: Track, flag: Column, index: str) -> Track:
    """Flag the rows where a run opens and where it closes."""
    marked = source.derive({"_flag": F.coalesce(flag, F.lit(False))})
    flagged_index = F.when(F.col("_flag"), F.col(index))
    marked = carry(marked, prev={"_was": flagged_index}, next={"_will": flagged_index})
    opens = F.col("_flag") & F.coalesce(F.col("_was") + 1 != F.col(index), F.lit(True))
    closes = F.col("_flag") & F.coalesce(F.col("_will") - 1 != F.col(index), F.lit(True))
    marked = marked.derive({"_open": opens, "_close": closes})
    return replace(marked, df=marked.df.drop("_was", "_will"))


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Zero-based row numbers over a whole table, in ``order`` (which must tell all rows apart).

    Rows are dealt by ranges of ``order`` and written once, so that every range knows its
    rows for good; the counts of the ranges, one row each, carry the numbers forward.
    """
    order = list(order)
    dealt = durable(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    placed = dealt.withColumn(name, inside).join(F.broadcast(starts), "_range")  # one row a range
    return placed.withColumn(name, (F.col("_start") + F.col(name)).cast("bigint")).drop("_range", "_start")
