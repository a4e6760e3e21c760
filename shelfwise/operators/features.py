"""Feature selection, scaling and encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import CATEGORICAL_COLUMNS, present

# Numeric features and target of the rating model.
NUMERIC_COLUMNS = ("price_numeric",)
TARGET = "Rating"


def feature_order(
    df: DataFrame, numeric: Sequence[str] = NUMERIC_COLUMNS, categorical: Sequence[str] = CATEGORICAL_COLUMNS,
) -> list[str]:
    """Present numeric features, then present categorical ones. Reads no data."""
    return present(df, numeric) + present(df, categorical)


def split_roles(features: Sequence[str], numeric: Sequence[str] = NUMERIC_COLUMNS) -> tuple[list[str], list[str]]:
    return [f for f in features if f in numeric], [f for f in features if f not in numeric]


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Add each column with mean 0 and population deviation 1; constants become 0.

    Means and deviations are one aggregation, entering as a scalar subquery.
    """
    moments = df.agg(F.struct(*[
        of(c).alias(f"{name}_{c}") for c in columns for name, of in (("mean", F.avg), ("sd", F.stddev_pop))
    ])).scalar()
    scaled = []
    for c in columns:
        sd = F.col(f"__moments.sd_{c}")
        divisor = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        scaled.append(((F.col(c) - F.col(f"__moments.mean_{c}")) / divisor).alias(c + suffix))
    return df.select("*", moments.alias("__moments")).select(*df.columns, *scaled)


def encoding_stages(
    features: Sequence[str], scale: bool = True, numeric: Sequence[str] = NUMERIC_COLUMNS, output: str = "features",
) -> list:
    """ML stages from columns to one sparse vector.

    A category unseen in training takes the index past the known ones, which the
    encoder (dropping the last slot) turns into all zeros.
    """
    numbers, categories = split_roles(features, numeric)
    stages: list = []
    parts: list[str] = []
    if numbers:
        stages.append(VectorAssembler(inputCols=numbers, outputCol="numbers"))
        parts.append("numbers")
        if scale:
            stages.append(StandardScaler(inputCol="numbers", outputCol="numbers_scaled", withMean=True, withStd=True))
            parts = ["numbers_scaled"]
    if categories:
        indexed = [f"{c}_index" for c in categories]
        encoded = [f"{c}_onehot" for c in categories]
        stages.append(StringIndexer(
            inputCols=categories, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
        ))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True, handleInvalid="error"))
        parts += encoded
    stages.append(VectorAssembler(inputCols=parts, outputCol=output))
    return stages


def one_hot(df: DataFrame, fit_on: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One-hot encode columns with the categories seen in ``fit_on``."""
    return Pipeline(stages=encoding_stages(columns, scale=False)).fit(fit_on).transform(df)
