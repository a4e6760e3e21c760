"""Exploration tables: what a chart of the catalog would show."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.ordering import running_total
from shelfwise.session import materialize

BINS = 30
GRID = 200
WHISKER = 1.5


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"))


def head(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def _report(df: DataFrame, columns: Sequence[str], name: str, measures: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregation over all columns, turned into one row per column."""
    flat = df.agg(*[
        value.alias(f"{measure}__{c}") for measure, per_column in measures.items() for c, value in per_column.items()
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias(name), *[F.col(f"{measure}__{c}").alias(measure) for measure in measures])
        for c in columns
    ])
    return flat.select(F.inline(rows))


def missing_counts(df: DataFrame) -> DataFrame:
    """Columns with missing values, most missing first."""
    counts = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    return (
        _report(df, df.columns, "column", {"n_missing": counts})
        .filter(F.col("n_missing") > 0).orderBy(F.desc("n_missing"), "column")
    )


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type and number of distinct values (nulls aside) of each column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    report = _report(df, df.columns, "column", {"n_distinct": {c: count(F.col(c)) for c in df.columns}})
    type_name = F.lit(None).cast("string")
    for name, text in types.items():
        type_name = F.when(F.col("column") == F.lit(name), F.lit(text)).otherwise(type_name)
    return report.select("column", type_name.alias("type"), "n_distinct")


def value_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Smallest and largest value of each numeric column."""
    columns = list(columns or numeric_columns(df))
    as_double = {c: F.col(c).cast("double") for c in columns}
    return _report(df, columns, "feature", {
        "min_value": {c: F.min(v) for c, v in as_double.items()},
        "max_value": {c: F.max(v) for c, v in as_double.items()},
    })


def _long(df: DataFrame, columns: Sequence[str], name: str = "feature", value: str = "value", cast: str = "double") -> DataFrame:
    """One row per column and non-null value."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast(cast).alias(value)) for c in columns])
    return df.select(F.inline(pairs)).filter(F.col(value).isNotNull())


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of each column occurs; counted before the shuffle."""
    return _long(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = BINS) -> DataFrame:
    """Equal-width bins between smallest and largest value; the last bin is closed.

    The ranges of all columns are one aggregation that enters the binning as a
    scalar subquery, so the data is scanned twice and only bin counts are
    shuffled. A constant column gets the unit range around its value.
    """
    columns = list(columns or numeric_columns(df))
    ranges = df.agg(F.struct(*[
        of(F.col(c).cast("double")).alias(f"{name}_{c}") for c in columns for name, of in (("low", F.min), ("high", F.max))
    ])).scalar()
    ranged = df.select(*columns, ranges.alias("__ranges"))
    entries = []
    for c in columns:
        low, high = F.col(f"__ranges.low_{c}"), F.col(f"__ranges.high_{c}")
        start = F.when(low == high, low - 0.5).otherwise(low)
        end = F.when(low == high, low + 0.5).otherwise(high)
        place = F.floor((F.col(c).cast("double") - start) / (end - start) * F.lit(bins)).cast("int")
        entries.append(F.struct(
            F.lit(c).alias("feature"), F.least(place, F.lit(bins - 1)).alias("bin"), start.alias("start"), end.alias("end")
        ))
    width = (F.col("end") - F.col("start")) / F.lit(float(bins))
    return (
        ranged.select(F.inline(F.array(*entries))).filter(F.col("bin").isNotNull())
        .groupBy("feature", "bin", "start", "end").agg(F.count(F.lit(1)).alias("n"))
        .select(
            "feature", "bin", (F.col("start") + F.col("bin") * width).alias("bin_start"),
            (F.col("start") + (F.col("bin") + 1) * width).alias("bin_end"), "n",
        )
    )


def density_curve(df: DataFrame, column: str, grid: int = GRID, bins: int = BINS) -> DataFrame:
    """Gaussian kernel density on a grid over the range, exact.

    Bandwidth after Scott. Equal values are counted first, so the kernel is
    worked out once per distinct value and grid point and summed up before the
    shuffle, which moves one partial sum per grid point and task. ``curve`` is
    the density on the scale of the histogram's counts.
    """
    x = F.col("value")
    counts = value_counts(df, [column])
    known = F.col(column).cast("double")
    stats = df.agg(F.struct(
        F.count(known).cast("double").alias("n"), F.min(known).alias("low"), F.max(known).alias("high"),
        (F.pow(F.count(known).cast("double"), F.lit(-0.2)) * F.stddev_samp(known)).alias("bandwidth"),
    )).scalar()
    total, low, high, bandwidth = (F.col(f"__stats.{name}") for name in ("n", "low", "high", "bandwidth"))
    point = low + (high - low) * F.col("position") / F.lit(float(grid - 1))
    distance = (point - x) / bandwidth
    sums = (
        counts.select("value", "n", stats.alias("__stats"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("position"))
        .groupBy("position", "__stats").agg(F.sum(F.col("n") * F.exp(distance * distance * -0.5)).alias("kernel"))
    )
    density = F.col("kernel") / (total * bandwidth * F.sqrt(F.lit(2.0) * F.pi()))
    return sums.select(
        F.lit(column).alias("feature"), "position", point.alias("x"), density.alias("density"),
        (density * total * (high - low) / F.lit(float(bins))).alias("curve"),
    )


def binned_density(df: DataFrame, column: str, grid: int = GRID, bins: int = BINS, cells: int | None = None, accuracy: float = 1e-4) -> DataFrame:
    """The density curve by linear binning: work independent of the number of distinct values.

    Each value is dealt to the two cells beside it; the kernel is then worked out once per cell and near grid point.
    With cells of width d and bandwidth h the density is off by at most d² / (8 h²) of a single kernel's peak,
    1 / (h √(2π)). ``cells`` is chosen to keep that share below ``accuracy``, or given. Beyond
    eight bandwidths a cell adds nothing (less than 10^-13 of a peak). Columns and scale are those of ``density_curve``; a column without spread, or
    without values, has no curve.
    """
    known = F.col(column).cast("double")
    stats = df.agg(
        F.count(known).alias("n"), F.min(known).alias("low"), F.max(known).alias("high"), (F.pow(F.count(known).cast("double"), F.lit(-0.2)) * F.stddev_samp(known)).alias("h"),
    ).first()
    schema = "feature string, position int, x double, density double, curve double"
    if not stats["n"] or not stats["h"]:
        return df.sparkSession.createDataFrame([], schema)
    low, high, h = stats["low"], stats["high"], stats["h"]
    if cells is None:
        cells = 2 + int((high - low) / (h * (8 * accuracy) ** 0.5))
    width, step = (high - low) / (cells - 1), (high - low) / (grid - 1)
    place = (known - low) / width
    cell = F.floor(place)
    share = place - cell
    dealt = F.array(F.struct(cell.alias("cell"), (1 - share).alias("weight")), F.struct((cell + 1).alias("cell"), share.alias("weight")))
    weights = df.filter(known.isNotNull()).select(F.inline(dealt)).groupBy("cell").agg(F.sum("weight").alias("weight"))  # `cells` rows at most
    centre = F.lit(low) + F.col("cell") * width
    first, last = (F.floor((centre + sign * 8 * h - low) / step).cast("int") for sign in (-1, 1))
    near = F.sequence(F.greatest(F.lit(0), first), F.least(F.lit(grid - 1), last))
    point = F.lit(low) + (high - low) * F.col("position") / float(grid - 1)
    distance = (point - centre) / h
    sums = weights.select("cell", "weight", F.explode(near).alias("position")).groupBy("position").agg(F.sum(F.col("weight") * F.exp(distance * distance * -0.5)).alias("kernel"))
    every = df.sparkSession.range(grid, numPartitions=1).select(F.col("id").cast("int").alias("position")).join(sums, "position", "left")
    density = F.coalesce("kernel", F.lit(0.0)) / (float(stats["n"]) * h * F.sqrt(F.lit(2.0) * F.pi()))
    return every.select(F.lit(column).alias("feature"), "position", point.alias("x"), density.alias("density"), (density * float(stats["n"]) * (high - low) / float(bins)).alias("curve"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of all column pairs over rows where both are known.

    One aggregation; each unordered pair is worked out once. A constant column
    has none, also with itself.
    """
    columns = list(columns or numeric_columns(df))
    measures, rows = [], []
    for i, a in enumerate(columns):
        for j in range(i, len(columns)):
            b = columns[j]
            x, y = F.col(a).cast("double"), F.col(b).cast("double")
            both = x.isNotNull() & y.isNotNull()
            xx, yy = F.when(both, x), F.when(both, y)
            spread = F.stddev_pop(xx) * F.stddev_pop(yy)
            measures.append(F.try_divide(F.covar_pop(xx, yy), spread).alias(f"r_{i}_{j}"))
            rows.append((a, b, f"r_{i}_{j}"))
            if i != j:
                rows.append((b, a, f"r_{i}_{j}"))
    entries = F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(r).alias("correlation"))
        for a, b, r in rows
    ])
    return df.agg(*measures).select(F.inline(entries))


def scatter_points(df: DataFrame, target: str, columns: Sequence[str], key: str = "id") -> DataFrame:
    """The points of target against each numeric column."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
        for c in columns if c != target
    ])
    return df.select(F.col(key), F.col(target).alias("y"), F.inline(entries)).filter(
        F.col("x").isNotNull() & F.col("y").isNotNull()
    )


def top_categories(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The most frequent values of each column, nulls aside; ties by value.

    All columns are counted in one pass, before the shuffle.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns])
    counts = (
        df.select(F.inline(entries)).filter(F.col("category").isNotNull())
        .groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
    )
    most = Window.partitionBy("feature").orderBy(F.desc("n"), "category")
    return counts.withColumn("rank", F.row_number().over(most)).filter(F.col("rank") <= n)


def _category_values(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns])
    return df.select(F.col(target).alias("value"), F.inline(entries)).filter(
        F.col("category").isNotNull() & F.col("value").isNotNull()
    )


_PARTS = 64


def _in_parts(df: DataFrame, group: Sequence[str], first: dict[str, Column], then: dict[str, Callable[[str], Column]]) -> DataFrame:
    """An aggregation by group and a hash of the value, then by group.

    No step needs all rows of a group in one task, so the join below may split a hot category.
    """
    part = F.pmod(F.xxhash64("value"), F.lit(_PARTS)).alias("part")
    parts = df.groupBy(*group, part).agg(*[column.alias(name) for name, column in first.items()])
    return parts.groupBy(*group).agg(*[then[name](name).alias(name) for name in first])


_QUARTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
_ACCURACY = 10_000


def _exact_quartiles(values: DataFrame, group: Sequence[str]) -> DataFrame:
    """n and quartiles, linear between ranks, without sorting more than a small part of the values.

    Bounds a little below and above each quartile, from Spark's quantile sketch, cut a group's values into seven cells. All
    values are counted by cell, and only the cells that hold a wanted rank are looked into: their distinct values are counted
    and ranked by running totals, cut by range. How well the sketch does decides the size of these cells, never the result.
    """
    near = [q + side * 3 / _ACCURACY for _, q in _QUARTILES for side in (-1, 1)]
    bounds = materialize(values.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"), F.percentile_approx("value", F.array(*[F.lit(q) for q in near]), F.lit(_ACCURACY)).alias("bounds"),
    ), "bounds")
    cell = sum((F.when(F.col("value") >= F.col("bounds")[i], 1).otherwise(0) for i in range(len(near))), F.lit(0))
    cells = _in_parts(values.join(bounds, group).withColumn("cell", cell), [*group, "cell"], {"n": F.count(F.lit(1))}, {"n": F.sum})
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy("cell"))  # seven rows a group at most
    cells = cells.withColumn("before", upto - F.col("n")).join(bounds, group)
    places = {name: (F.col("total") - 1) * F.lit(q) for name, q in _QUARTILES}
    ranks = {f"{name}_{side}": to(place) for name, place in places.items() for side, to in (("low", F.floor), ("high", F.ceil))}
    here = {name: (F.col("before") <= rank) & (rank < F.col("before") + F.col("n")) for name, rank in ranks.items()}
    wanted = F.lit(False)
    for holds in here.values():
        wanted = wanted | holds
    opened = materialize(
        cells.filter(wanted).groupBy(*group, "total", "bounds")
        .agg(F.map_from_entries(F.collect_list(F.struct("cell", "before"))).alias("earlier")), "opened",
    )
    inside = (
        values.join(opened, group).withColumn("cell", cell).withColumn("earlier", F.col("earlier")[F.col("cell")])
        .filter(F.col("earlier").isNotNull()).groupBy(*group, "cell", "total", "earlier", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_total(inside, ["value"], "n", "upto", partition_by=[*group, "cell"])
    placed = ranked.withColumn("before", F.col("earlier") + F.col("upto") - F.col("n"))
    picks = {"n": F.max("total")} | {name: F.max(F.when(holds, F.col("value"))) for name, holds in here.items()}
    found = _in_parts(placed, group, picks, dict.fromkeys(picks, F.max))
    return found.select(*group, "n", *[
        (F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low"))
         * ((F.col("n") - 1) * F.lit(q) - F.floor((F.col("n") - 1) * F.lit(q)))).alias(name)
        for name, q in _QUARTILES
    ])


def _box_figures(df: DataFrame, target: str, columns: Sequence[str], exact: bool) -> DataFrame:
    """The box plots of a frame that is cheap to read several times."""
    values, group = _category_values(df, target, columns), ["feature", "category"]
    if exact:
        quartiles = _exact_quartiles(values, group)
    else:
        sketch = F.percentile_approx("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(_ACCURACY))
        quartiles = (
            values.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), sketch.alias("q"))
            .select(*group, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
        )
    quartiles = materialize(quartiles, "quartiles")
    reach = (F.col("q3") - F.col("q1")) * F.lit(WHISKER)
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    whiskers = _in_parts(
        values.join(quartiles, group), group,
        {
            "whisker_low": F.min(F.when(inside, F.col("value"))), "whisker_high": F.max(F.when(inside, F.col("value"))),
            "n_outliers": F.sum(F.when(inside, F.lit(0)).otherwise(F.lit(1))),
        },
        {"whisker_low": F.min, "whisker_high": F.max, "n_outliers": F.sum},
    )
    return quartiles.join(whiskers, group)


def boxplot_stats(df: DataFrame, target: str, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Quartiles, whiskers and outlier count of the target per category.

    The target and the columns are worked out and written once, as they are read four times. ``exact=False`` takes the
    quartiles from Spark's quantile sketch.
    """
    return _box_figures(materialize(df.select(*dict.fromkeys([target, *columns])), "boxed"), target, columns, exact)


def boxplot_outliers(
    df: DataFrame, target: str, columns: Sequence[str], key: str = "id", exact: bool = True, stats: DataFrame | None = None,
) -> DataFrame:
    """The single points beyond the whiskers, of ``stats`` where they are there already.

    The whiskers are written out first: with their size known, Spark broadcasts
    them where they are small, and the points are then not shuffled at all.
    """
    if stats is None:
        df = materialize(df.select(*dict.fromkeys([key, target, *columns])), "boxed")
        stats = _box_figures(df, target, columns, exact)
    stats = materialize(stats.select("feature", "category", "whisker_low", "whisker_high"), "whiskers")
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns])
    points = df.select(F.col(key), F.col(target).alias("value"), F.inline(entries))
    beyond = (F.col("value") < F.col("whisker_low")) | (F.col("value") > F.col("whisker_high"))
    return points.join(stats, ["feature", "category"]).filter(beyond).select("feature", "category", key, "value")
