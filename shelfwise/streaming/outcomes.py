"""Requests joined with their later outcomes, both as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_outcomes(
    requests: DataFrame, outcomes: DataFrame, request_key: str, outcome_key: str, request_time: str, outcome_time: str, within: str, delay: str = "1 hour", outcome_delay: str | None = None,
) -> DataFrame:
    """Every request with its outcomes up to ``within`` later; without one, a row with nulls once none can come any more.

    Both sides keep their rows as state only until the other side's watermark says that no partner can come. Times count
    with both ends. Columns of the two sides need different names. The same expression joins batches (there every request
    without an outcome is returned). Requests with a null key or time match nothing.
    """
    if clash := set(requests.columns) & set(outcomes.columns):
        raise ValueError(f"both streams have {sorted(clash)}")
    left, right = requests, outcomes
    if requests.isStreaming:
        left = requests.withWatermark(request_time, delay)
        right = outcomes.withWatermark(outcome_time, outcome_delay or delay)
    later = (F.col(outcome_time) >= F.col(request_time)) & (F.col(outcome_time) <= F.col(request_time) + F.expr(f"INTERVAL {within}"))
    return left.join(right, (F.col(request_key) == F.col(outcome_key)) & later, "left_outer")
