"""Exploration report: every table of the exploration over one preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import CATEGORICAL_COLUMNS, extract_price, normalize_na, present, with_linear_rating
from shelfwise.operators import explore
from shelfwise.operators.features import TARGET
from shelfwise.session import materialize


def explored(catalog: DataFrame) -> DataFrame:
    """The catalog as explored: missing words cleared, price and rating derived, gaps kept."""
    return with_linear_rating(extract_price(normalize_na(catalog)))


def eda_report(catalog: DataFrame, key: str = "id", exact: bool = True) -> dict[str, DataFrame]:
    """All report tables by name; each is its own small result.

    The explored columns are cleaned and written once; outliers use the box-plot's own figures.
    """
    df = materialize(explored(catalog), "explored")
    categories = present(df, CATEGORICAL_COLUMNS)
    numbers = explore.numeric_columns(df)
    boxes = materialize(explore.boxplot_stats(df, TARGET, categories, exact), "boxes")
    tables = {
        "shape": explore.shape(df),
        "missing_counts": explore.missing_counts(df),
        "distinct_counts": explore.distinct_counts(df, approximate=not exact),
        "value_ranges": explore.value_ranges(df, numbers),
        "histogram": explore.histogram(df, numbers),
        "correlation_matrix": explore.correlation_matrix(df, numbers),
        "scatter_points": explore.scatter_points(df, TARGET, [c for c in numbers if c != TARGET], key),
        "top_categories": explore.top_categories(df, categories),
        "boxplot_stats": boxes,
        "boxplot_outliers": explore.boxplot_outliers(df, TARGET, categories, key, exact, boxes),
    }
    tables |= {f"density_{c}": explore.density_curve(df, c) for c in numbers if c != key}
    return tables


#: What the long form takes of each table: the columns that name an item, and its measures.
LONG = {
    "shape": ((), ("n_rows", "n_columns")),
    "missing_counts": (("column",), ("n_missing",)),
    "distinct_counts": (("column",), ("n_distinct",)),
    "value_ranges": (("feature",), ("min_value", "max_value")),
    "histogram": (("feature", "bin"), ("bin_start", "bin_end", "n")),
    "correlation_matrix": (("feature_a", "feature_b"), ("correlation",)),
    "top_categories": (("feature", "category"), ("n", "rank")),
    "boxplot_stats": (("feature", "category"), ("n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers")),
}


def eda_report_long(catalog: DataFrame, key: str = "id", exact: bool = True) -> DataFrame:
    """The report's tables in one: table, item, measure, value. Points and curves, which are rows already, are left to the tables."""
    tables = eda_report(catalog, key, exact)
    parts = []
    for name, (items, measures) in LONG.items():
        item = F.concat_ws("|", *[F.col(c).cast("string") for c in items]) if items else F.lit("")
        pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
        parts.append(tables[name].select(F.lit(name).alias("table"), item.alias("item"), F.inline(pairs)))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    return every
