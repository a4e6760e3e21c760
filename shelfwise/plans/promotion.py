"""Promotion job: newest ready version, gate, registration, for all models in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise.operators.registry import (
    PROMOTION_THRESHOLD, fetch_models, gate_with_reasons, latest_promotable, promote_models,
)


def promotion_job(
    source: DataFrame, target: DataFrame, source_project: str, target_project: str, promotion_date: str,
    threshold: float = PROMOTION_THRESHOLD, build_number: str = "unknown", names: DataFrame | None = None,
    promotion_timestamp: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Gate records (refusals included) and registration records."""
    models = latest_promotable(source) if names is None else fetch_models(source, names)
    gate = gate_with_reasons(models, threshold)
    return gate, promote_models(gate, source, target, source_project, target_project, promotion_date, build_number, promotion_timestamp=promotion_timestamp)
