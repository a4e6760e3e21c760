"""Cleaning expressions: missing-value words, prices, ratings, grades."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.hashing import hash_normal

# The texts a pandas CSV reader takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Column roles of a catalog.
CATEGORICAL_COLUMNS = ("Country", "Region", "Type", "Style", "Grape")
BATCH_CATEGORICAL_COLUMNS = ("Country", "Type", "Grape", "Style")
TEXT_COLUMNS = ("Characteristics", "Grape", "Style", "Type", "Country", "Region")

# Price pattern and rating bonuses of the batch rating.
PRICE_PATTERN = r"(\d+\.?\d*)"
COUNTRY_BONUS = {"France": 0.5, "Italy": 0.3, "Spain": 0.2, "Germany": 0.3, "USA": 0.2, "Australia": 0.1}
TYPE_BONUS = {"Red": 0.2, "White": 0.1, "Sparkling": 0.3}
OTHER_BONUS = 0.1


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The given columns that the frame has, in the given order."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def na_to_null(column: Column) -> Column:
    return F.when(~column.isin(*NA_TOKENS), column)


def normalize_na(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Turn missing-value words into nulls in the given (default: all) text columns."""
    wanted = set(df.columns if columns is None else columns)
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        na_to_null(F.col(c)).alias(c) if c in wanted and c in text else F.col(c) for c in df.columns
    ])


def fill_categoricals(df: DataFrame, columns: Iterable[str] = CATEGORICAL_COLUMNS, token: str = "Unknown") -> DataFrame:
    """Fill nulls of those of the columns that exist."""
    found = present(df, columns)
    return df.fillna(token, subset=found) if found else df


def price_from_text(column: Column, default: float = 0.0) -> Column:
    """The first number in a text, else the default."""
    found = F.nullif(F.regexp_extract(column, PRICE_PATTERN, 1), F.lit(""))
    return F.coalesce(found.try_cast("double"), F.lit(float(default)))


def coerce_number(column: Column, default: float) -> Column:
    """A text or number as double; what is no number becomes the default."""
    value = column.try_cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(float(default))).otherwise(value)


def extract_price(df: DataFrame, default: float = 0.0, source: str = "Price", target: str = "price_numeric") -> DataFrame:
    """Derive the numeric price.

    Text is searched for its first number. A numeric price column has no sign
    in that reading either, so its absolute value is taken. With no price
    column a supplied numeric price is coerced, and failing that the default
    holds for every row.
    """
    if source in df.columns:
        if isinstance(df.schema[source].dataType, T.NumericType):
            return df.withColumn(target, coerce_number(F.abs(F.col(source)), default))
        return df.withColumn(target, price_from_text(F.col(source).cast("string"), default))
    if target in df.columns:
        return df.withColumn(target, coerce_number(F.col(target), default))
    return df.withColumn(target, F.lit(float(default)))


def linear_rating(price: Column, slope: float = 0.2, base: float = 3.0, low: float | None = None, high: float = 5.0) -> Column:
    """A rating growing with the price between optional bounds."""
    raw = price * F.lit(slope) + F.lit(base)
    capped = F.least(raw, F.lit(high))
    return capped if low is None else F.greatest(capped, F.lit(low))


def with_linear_rating(
    df: DataFrame, slope: float = 0.2, base: float = 3.0, low: float | None = None, high: float = 5.0,
    overwrite: bool = False, target: str = "Rating",
) -> DataFrame:
    """Add the rating target where the frame has none (or always, with ``overwrite``)."""
    if target in df.columns and not overwrite:
        return df
    return df.withColumn(target, linear_rating(F.col("price_numeric"), slope, base, low, high))


def bonus(column: Column, table: Mapping[str, float], other: float = OTHER_BONUS) -> Column:
    """Look a value up in a small literal table; unknown and null get ``other``."""
    chain = F.lit(float(other))
    for key, value in table.items():
        chain = F.when(column == F.lit(key), F.lit(float(value))).otherwise(chain)
    return chain


def bonus_rating(
    price: Column, country: Column, kind: Column, key: Column, seed: int = 42, noise_sd: float = 0.2,
    country_bonus: Mapping[str, float] = COUNTRY_BONUS, type_bonus: Mapping[str, float] = TYPE_BONUS,
) -> Column:
    """Price trend plus lookup bonuses plus per-row noise, kept within 3 to 5."""
    raw = (
        F.lit(3.2) + price * F.lit(0.03) + bonus(country, country_bonus) + bonus(kind, type_bonus)
        + hash_normal(key, seed, noise_sd)
    )
    return F.greatest(F.least(raw, F.lit(5.0)), F.lit(3.0))


def combined_features(df: DataFrame, target: str = "combined_features") -> DataFrame:
    """Join the describing columns into one text; gaps of missing values stay."""
    columns = present(df, TEXT_COLUMNS)
    parts = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    pieces: list[Column] = []
    for name, part in zip(columns, parts):
        pieces.append(part)
        if name != TEXT_COLUMNS[-1]:
            pieces.append(F.lit(" "))
    joined = F.concat(*pieces) if pieces else F.lit("")
    return df.withColumn(target, F.btrim(joined, F.lit(" \t\n\r\f\v")))


def quality_grade(score: Column) -> Column:
    """Grade of the unrounded score."""
    return (
        F.when(score >= 4.5, F.lit("Excellent")).when(score >= 4.0, F.lit("Good")).otherwise(F.lit("Average"))
    )
