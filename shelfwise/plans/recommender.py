"""Recommender job: combined text, similar items, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import TEXT_COLUMNS, combined_features, fill_categoricals, normalize_na
from shelfwise.operators.similarity import display_name, similarity_coverage, top_similar


def catalog_texts(catalog: DataFrame, key: str = "id") -> DataFrame:
    """id, name and combined text of each item."""
    named = display_name(catalog, key)
    return combined_features(fill_categoricals(normalize_na(named), TEXT_COLUMNS, "")).select(key, "name", "combined_features")


def recommend(catalog: DataFrame, k: int = 5, wanted: DataFrame | None = None, key: str = "id") -> DataFrame:
    """The k most similar items of every item, or of the wanted ones."""
    return top_similar(catalog_texts(catalog, key), key, "combined_features", k, wanted)


def recommender_quality(catalog: DataFrame, threshold: float = 0.5, gate: float = 0.0, key: str = "id") -> DataFrame:
    """Coverage of the recommender and whether it reaches the gate."""
    covered = similarity_coverage(catalog_texts(catalog, key), key, "combined_features", threshold)
    return covered.withColumn("gate_passed", F.coalesce(F.col("coverage_score") >= gate, F.lit(False)))
