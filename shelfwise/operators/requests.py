"""Prediction requests: ``{"instances": [...]}`` documents to feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import coerce_number
from shelfwise.operators.features import NUMERIC_COLUMNS

# Positional order of request features.
REQUEST_ORDER = ("price_numeric", "Country", "Region", "Type", "Style", "Grape")


def explode_requests(
    df: DataFrame, value: str = "value", features: Sequence[str] = REQUEST_ORDER, keep: Sequence[str] = (),
) -> DataFrame:
    """One row per instance: kept columns, position, features as text, status and error.

    An instance is a list in feature order or an object with feature names. A
    document or instance that cannot be read gives one FAILED row.
    """
    names = list(features)
    document = F.from_json(F.col(value), "instances array<string>")
    by_name = ", ".join(f"`{n}` string" for n in names)
    opened = df.select(
        *keep, F.posexplode_outer(F.coalesce(document["instances"], F.array().cast("array<string>"))).alias("position", "instance")
    )
    listed = F.from_json("instance", "array<string>")
    named = F.from_json("instance", f"struct<{by_name}>")
    parsed = opened.withColumn(
        "listed", F.when(F.startswith("instance", F.lit("[")), listed)
    ).withColumn("named", F.when(F.startswith("instance", F.lit("{")), named))
    length_fits = F.coalesce(F.size("listed") == len(names), F.lit(False))
    ok = length_fits | F.col("named").isNotNull()
    error = (
        F.when(F.col("instance").isNull(), F.lit("no instances in document"))
        .when(F.col("listed").isNotNull() & ~length_fits, F.concat(
            F.lit(f"expected {len(names)} features, got "), F.size("listed").cast("string")))
        .when(~ok, F.lit("instance is neither list nor object"))
    )
    columns = [
        F.when(length_fits, F.get("listed", F.lit(i))).otherwise(F.col("named")[n]).alias(n) for i, n in enumerate(names)
    ]
    return parsed.select(
        *keep, F.coalesce("position", F.lit(0)).alias("position"), *columns,
        F.when(ok, F.lit("OK")).otherwise(F.lit("FAILED")).alias("status"), error.alias("error"),
    )


def clean_requests(
    df: DataFrame, features: Sequence[str] = REQUEST_ORDER, default_price: float = 0.0, token: str = "Unknown",
) -> DataFrame:
    """Numbers coerced, missing categories filled: ready for a model."""
    cleaned = {
        n: coerce_number(F.col(n), default_price) if n in NUMERIC_COLUMNS else F.coalesce(F.col(n), F.lit(token))
        for n in features if n in df.columns
    }
    return df.withColumns(cleaned)
