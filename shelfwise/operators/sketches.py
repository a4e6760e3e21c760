"""Quantile and distinct sketches kept as tables: one row for each part of the data, merged into reports without reading rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUANTILE_K = 400  # accuracy of quantile sketches
DISTINCT_LOG2 = 14  # 2 ** 14 registers of distinct sketches
#: Errors that hold with a chance of 99 %: of a quantile's rank, as a share of the rows; of a distinct number, relative.
RANK_ERROR = 2.446 / QUANTILE_K**0.9433  # as published for the quantile sketch, both sides
DISTINCT_ERROR = 2.58 * 1.04 / 2 ** (DISTINCT_LOG2 / 2)


def build_sketches(df: DataFrame, by: Sequence[str], values: Sequence[str] = (), distinct: Sequence[str] = ()) -> DataFrame:
    """A row for each combination of ``by``: rows, sketches of ``values`` (numbers) and of distinct values of ``distinct``.

    Beside the sketches: the number of known values, their least and largest. Null values are left out; a column
    without known values has a null sketch. Partial sketches are built before the shuffle, so a combination that a third
    of the rows have costs no more than others.
    """
    measures: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for c in values:
        x = F.col(c).cast("double")
        measures += [F.count(x).alias(f"{c}_known"), F.min(x).alias(f"{c}_least"), F.max(x).alias(f"{c}_largest"), F.kll_sketch_agg_double(x, QUANTILE_K).alias(f"{c}_quantiles")]
    measures += [F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT_LOG2).alias(f"{c}_distinct") for c in distinct]
    return df.groupBy(*by).agg(*measures)


def write_sketches(sketches: DataFrame, path: str, part: str) -> None:
    """Put the sketches of some parts of the data (a day, a file) into the stored table; parts that are there are replaced."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups, from stored ones: a row for each combination of ``by``, one row without."""
    measures: list[Column] = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    for c in (name.removesuffix("_quantiles") for name in sketches.columns if name.endswith("_quantiles")):
        measures += [F.coalesce(F.sum(f"{c}_known"), F.lit(0)).alias(f"{c}_known"), F.min(f"{c}_least").alias(f"{c}_least"), F.max(f"{c}_largest").alias(f"{c}_largest")]
        measures.append(F.kll_merge_agg_double(F.when(F.col(f"{c}_known") > 0, F.col(f"{c}_quantiles")), QUANTILE_K).alias(f"{c}_quantiles"))
    measures += [F.hll_union_agg(name).alias(name) for name in sketches.columns if name.endswith("_distinct")]
    return sketches.groupBy(*by).agg(*measures)


def sketch_report(sketches: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(by, column, rows, known, least, largest, q25, ..., distinct): what stored sketches say of each column.

    A quantile lies between the values whose ranks are ``RANK_ERROR`` of the rows lower and higher; a distinct number is
    within ``DISTINCT_ERROR`` of the true one. Least and largest are exact.
    """
    entries = []
    names = [f"q{round(q * 100):02d}" for q in quantiles]
    for name in sketches.columns:
        empty = {**{k: F.lit(None).cast("double") for k in ("least", "largest", *names)}, "known": F.lit(None).cast("bigint"), "distinct": F.lit(None).cast("bigint")}
        if name.endswith("_quantiles"):
            c = name.removesuffix("_quantiles")
            some = lambda v, c=c: F.when(F.col(f"{c}_known") > 0, v)
            found = {**empty, "known": F.col(f"{c}_known"), "least": F.col(f"{c}_least"), "largest": F.col(f"{c}_largest")}
            found |= {n: some(F.kll_sketch_get_quantile_double(name, F.lit(float(q)))) for n, q in zip(names, quantiles)}
        elif name.endswith("_distinct"):
            c, found = name.removesuffix("_distinct"), {**empty, "distinct": F.hll_sketch_estimate(name)}
        else:
            continue
        entries.append(F.struct(F.lit(c).alias("column"), *[v.alias(k) for k, v in sorted(found.items())]))
    listed = sketches.select(*by, "rows", F.explode(F.array(*entries)).alias("e"))
    return listed.select(*by, "e.column", "rows", *[f"e.{k}" for k in ("known", "least", "largest", *names, "distinct")])


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
