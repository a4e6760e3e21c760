"""Joins of overlapping intervals by an index of bins: equal bins are joined, the exact condition filters.

An interval lies in bins as wide as itself (the next power of two), so it
touches two at most, however long it is. Intervals of different widths meet on
the coarser one's bins. Bins that hold many rows are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.temporal import time_number
from shelfwise.session import materialize

HOT_ROWS = 20_000  # left rows of one bin from which it is split
_INTERNAL = ("__start", "__end", "__level", "__bin", "__first", "__up", "__salt")


def _with_span(df: DataFrame, span: tuple[str, str]) -> DataFrame:
    """Rows that can overlap anything, with the ends as doubles."""
    start, end = (time_number(df, c).cast("double").alias(n) for c, n in zip(span, _INTERNAL))
    rows = df.select("*", start, end)
    return rows.filter((F.col("__start") <= F.col("__end")) & ~F.isnan("__start") & ~F.isnan("__end"))


def _binned(rows: DataFrame, unit: float, levels: Sequence[int], bounds: tuple[float, float]) -> DataFrame:
    """Each interval in its own level's bins, and in those of the coarser ``levels``."""
    low, high = (F.lit(b).cast("double") for b in bounds)
    start, end = F.greatest("__start", low), F.least("__end", high)  # what is beyond all other rows, infinity too, need not be binned
    own = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest((end - start) / unit, F.lit(1.0))))).cast("int")
    rows = rows.filter((start <= end)).withColumns({"__own": own, "__s": start - low, "__e": end - low})
    level = F.explode(F.array_distinct(F.concat(F.array("__own"), F.filter(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: x > F.col("__own")))))
    width = F.lit(unit) * F.pow(F.lit(2.0), F.col("__level"))
    rows = rows.withColumn("__level", level).withColumns({"__first": F.floor(F.col("__s") / width), "__up": F.col("__level") > F.col("__own")})
    return rows.withColumn("__bin", F.explode(F.sequence(F.col("__first"), F.floor(F.col("__e") / width)))).drop("__own", "__s", "__e")


def _levels(rows: DataFrame, unit: float, bounds: tuple[float, float]) -> list[int]:
    """The levels that occur: some 60 at most, whatever the rows."""
    length = F.least("__end", F.lit(bounds[1])) - F.greatest("__start", F.lit(bounds[0]))
    own = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length / unit, F.lit(1.0))))).cast("int")
    return sorted(r[0] for r in rows.filter(length >= 0).select(own.alias("l")).distinct().collect())


def overlap_join(
    left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], on: Sequence[str] = (),
    closed: bool = True, unit: float | None = None, hot_rows: int = HOT_ROWS, left_columns: Sequence[str] | None = None,
    right_columns: Sequence[str] | None = None, prefix: str = "",
) -> DataFrame:
    """Pairs of rows whose intervals overlap and whose columns ``on`` are equal, each pair once.

    A span names the columns of start and end (twice the same one: points), numbers, dates or timestamps of one kind.
    ``closed`` intervals hold both ends, else the start only (points lie in those that hold them). The result has ``left_columns``, then ``right_columns``
    with ``prefix`` (all, if not named). ``unit`` is the width of the finest bins, by default about the median width of
    all intervals. Ends may be infinite.

    Rows with a null or NaN end, a null key, or an end before the start overlap nothing. Repeated rows pair up each.
    A bin with more than ``hot_rows`` left rows is split, its right rows copied to each part.
    """
    left_columns = list(left.columns if left_columns is None else left_columns)
    right_columns = list(right.columns if right_columns is None else right_columns)
    names = [prefix + c for c in right_columns]
    if clash := set(left_columns) & set(names):
        raise ValueError(f"both sides have {sorted(clash)}: give a prefix")
    pack = lambda df, span, columns, name: _with_span(df, span).select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(on)], "__start", "__end", F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]).alias(name)
    )
    one, two = pack(left, left_span, left_columns, "__left"), pack(right, right_span, right_columns, "__right")
    finite = lambda c: F.when(F.abs(c) < F.lit(float("inf")), F.col(c))
    sizes = []
    for side in (one, two):
        ends = F.array(finite("__start"), finite("__end"))
        sizes.append(side.agg(F.min(F.array_min(ends)), F.max(F.array_max(ends)), F.percentile_approx(finite("__end") - finite("__start"), 0.5), F.count(F.lit(1))).first())
    found = [(r[0], r[1]) for r in sizes if r[0] is not None]
    bounds = (min(b[0] for b in found), max(b[1] for b in found)) if found else (0.0, 0.0)
    if unit is None:
        widths = [r[2] for r in sizes if r[2]]
        unit = float(min(widths)) if widths else max((bounds[1] - bounds[0]) / 1024, 1.0)
    unit = max(unit, (bounds[1] - bounds[0]) / 2.0**52, 1e-300)
    levels = sorted({*_levels(one, unit, bounds), *_levels(two, unit, bounds)})
    one, two = _binned(one, unit, levels, bounds), _binned(two, unit, levels, bounds)

    keys = [*[f"__k{i}" for i in range(len(on))], "__level", "__bin"]
    hot = one.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
    hot = materialize(hot.select(*keys, F.ceil(F.col("__n") / hot_rows).cast("int").alias("__parts")), "hot-bins")
    parts = F.coalesce("__parts", F.lit(1))
    one = one.join(hot, keys, "left").withColumn("__salt", F.pmod(F.xxhash64("__left", "__start", "__end"), parts).cast("int")).drop("__parts")
    two = two.join(hot, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")

    a, b = one.alias("a"), two.alias("b")
    same = F.lit(True)
    for k in [*keys, "__salt"]:
        same = same & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    def reaches(x: str, y: str) -> Column:  # whether x begins before y ends
        before = F.col(f"{x}.__start") <= F.col(f"{y}.__end")
        if closed:
            return before
        point = F.col(f"{y}.__start") == F.col(f"{y}.__end")
        return before & (point | (F.col(f"{x}.__start") < F.col(f"{y}.__end")))

    overlap = reaches("a", "b") & reaches("b", "a")
    once = ~(F.col("a.__up") & F.col("b.__up")) & (F.col("a.__bin") == F.greatest("a.__first", "b.__first"))
    joined = a.join(b.hint("merge"), same & overlap & once)
    return joined.select(*[F.col(f"__left.c{i}").alias(c) for i, c in enumerate(left_columns)], *[F.col(f"__right.c{i}").alias(c) for i, c in enumerate(names)])


def point_join(points: DataFrame, intervals: DataFrame, at: str, span: tuple[str, str], **options) -> DataFrame:
    """Points with the intervals that hold them; options as for ``overlap_join``."""
    return overlap_join(points, intervals, (at, at), span, **options)


def within_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, after: float, prefix: str = "") -> DataFrame:
    """Left rows with the right rows of their key from 0 to ``after`` later (seconds for timestamps), once with nulls where there is none."""
    number = "__row"
    numbered = materialize(left.withColumn(number, F.monotonically_increasing_id()), "within-left")
    unit = 1_000_000 if dict(left.dtypes)[left_time].startswith("timestamp") else 1
    at = time_number(numbered, left_time)
    spans = numbered.filter(at.isNotNull()).select(*on, number, at.cast("double").alias("__a"), (at + after * unit).cast("double").alias("__b"))
    points = right.withColumn("__at", time_number(right, right_time).cast("double"))
    pairs = overlap_join(spans, points, ("__a", "__b"), ("__at", "__at"), on, left_columns=[number], right_columns=list(right.columns), prefix="__r_")
    joined = numbered.join(pairs, number, "left")
    return joined.select(*left.columns, *[F.col(f"__r_{c}").alias(prefix + c) for c in right.columns])
