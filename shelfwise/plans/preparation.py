"""The one preparation shared by training, scoring and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shelfwise.functions.cleaning import (
    CATEGORICAL_COLUMNS, extract_price, fill_categoricals, normalize_na, with_linear_rating,
)


def prepare(
    df: DataFrame, categorical: Sequence[str] = CATEGORICAL_COLUMNS, default_price: float = 0.0, rating: bool = True,
) -> DataFrame:
    """Missing words, categories, price and (for training) the rating target; narrow, no shuffle."""
    cleaned = extract_price(fill_categoricals(normalize_na(df), categorical), default_price)
    return with_linear_rating(cleaned) if rating else cleaned
