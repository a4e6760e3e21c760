"""Categories as numbers by a table that never comes to the driver, and by hashing.

The indexer of Spark ML brings all categories of a column to the driver. Here
the categories are a numbered table that rows are joined with; only the number
of categories of each column is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.ordering import number_rows
from shelfwise.session import materialize


def category_table(df: DataFrame, columns: Sequence[str], order: str = "frequency") -> DataFrame:
    """(feature, category, n, position): the categories of each column, numbered from 0, written out.

    By ``frequency`` the most common first, ties by category; by ``alphabet`` as they sort. Nulls are no category.
    Numbers are given by range, so a column with very many categories is no task's work alone.
    """
    if order not in ("frequency", "alphabet"):
        raise ValueError(f"order is frequency or alphabet, not {order}")
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns])
    counts = df.select(F.inline(entries)).filter(F.col("category").isNotNull()).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
    by = ["less", "category"] if order == "frequency" else ["category"]
    numbered = number_rows(counts.withColumn("less", -F.col("n")), by, "position", start=0, partition_by=["feature"])
    return materialize(numbered.select("feature", "category", "n", "position"), "categories")


def encode_categories(df: DataFrame, table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_position``, the category's number in the table; null where it is unknown or null."""
    for c in columns:
        own = table.filter(F.col("feature") == c).select(F.col("category").alias("__category"), F.col("position").alias(f"{c}_position"))
        df = df.join(own, F.col(c).cast("string") == F.col("__category"), "left").drop("__category")
    return df


def one_hot_by_table(df: DataFrame, table: DataFrame, columns: Sequence[str], output: str = "features", numeric: Sequence[str] = ()) -> DataFrame:
    """Add ``output``: the numbers, then one slot for each category of the table; unknown and null ones set none.

    The vectors are those of indexer and encoder with the categories in the table's order. Only the number of categories
    of each column comes to the driver, as metadata of the columns.
    """
    sizes = {r["feature"]: r["n"] for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each column
    rows = encode_categories(df, table, columns)
    known = [c for c in columns if sizes.get(c)]
    for c in known:
        attribute = {"ml_attr": {"type": "nominal", "num_vals": sizes[c] + 1}}
        rows = rows.withColumn(f"{c}_position", F.coalesce(F.col(f"{c}_position"), F.lit(sizes[c])).cast("double").alias(f"{c}_position", metadata=attribute))
    slots = [f"{c}_slots" for c in known]
    stages: list = []
    if known:
        stages.append(OneHotEncoder(inputCols=[f"{c}_position" for c in known], outputCols=slots, dropLast=True, handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=[*numeric, *slots], outputCol=output))
    fitted = Pipeline(stages=stages).fit(rows)  # by the metadata: no data is read
    return fitted.transform(rows).select(*df.columns, output)


def hash_features(df: DataFrame, columns: Sequence[str], slots: int = 1 << 18, output: str = "features") -> DataFrame:
    """Add ``output`` by feature hashing: ``column=value`` picks a slot. No table and no pass over the data; categories may share slots."""
    return FeatureHasher(inputCols=list(columns), outputCol=output, numFeatures=slots, categoricalCols=list(columns)).transform(df)
