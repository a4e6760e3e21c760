"""Totals over several groupings at once, with distinct counts exact or by mergeable sketches."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.sketches import DISTINCT_LOG2

LEVEL = "level"


def rollup_sets(columns: Sequence[str]) -> list[list[str]]:
    """All columns, then one less from the end each time, down to none."""
    return [list(columns[:n]) for n in range(len(columns), -1, -1)]


def cube_sets(columns: Sequence[str]) -> list[list[str]]:
    return [list(c) for n in range(len(columns), -1, -1) for c in combinations(columns, n)]


def totals_by(df: DataFrame, columns: Sequence[str], sets: Sequence[Sequence[str]], measures: dict[str, Column], distinct: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """(columns, level, measures, ``<column>_distinct``): a row for each combination of values of each grouping.

    ``level`` has a bit for each column, the last one lowest, set where the grouping leaves the column out; so a null
    that is a value differs from one that stands for all. Groupings given twice count once. An empty frame gives no
    row but that of the grouping without columns.

    Rows are expanded once, by the number of groupings, and added up before the shuffle. With ``exact=False`` distinct
    values are counted by sketches (within ``sketches.DISTINCT_ERROR``), which merge like sums: one shuffle of at most
    one row for each combination and task. Exact counts shuffle every distinct value of every grouping.
    """
    unique = [list(s) for s in dict.fromkeys(tuple(c for c in columns if c in s) for s in sets)]
    unknown = {c for s in sets for c in s} - set(columns)
    if unknown:
        raise ValueError(f"groupings have {sorted(unknown)} besides the columns")
    count = F.count_distinct if exact else lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(c.cast("string"), DISTINCT_LOG2)), F.lit(0))
    # a column that is counted is kept apart from the one that is grouped by, which the expansion empties
    counted = df.withColumns({f"__{c}": F.col(c) for c in distinct})
    found = [m.alias(n) for n, m in measures.items()] + [count(F.col(f"__{c}")).cast("bigint").alias(f"{c}_distinct") for c in distinct]
    grouped = counted.groupingSets([[F.col(c) for c in s] for s in unique], *columns)
    return grouped.agg(F.grouping_id().cast("int").alias(LEVEL), *found).select(*columns, LEVEL, *measures, *[f"{c}_distinct" for c in distinct])
