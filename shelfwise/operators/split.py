"""Reproducible train/test split by the hash of a row key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.hashing import key_digest
from shelfwise.session import materialize

_DIGITS = 4


def hash_split(df: DataFrame, key: str = "id", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: a row is test when its hash falls below the share. No shuffle."""
    bound = format(min(math.floor(test_size * 16 ** 8), 16 ** 8 - 1), "08x")
    low = F.substring(key_digest(F.col(key), seed), 1, 8) < F.lit(bound)
    return df.withColumn("split", F.when(low, "test").otherwise("train"))


def _cut(rows: DataFrame, bucket: Column, wanted: Column) -> DataFrame:
    """The one bucket that holds the wanted-th row in bucket order, and how many rows of it are wanted.

    The window is over at most 16 ** _DIGITS buckets, whatever the rows.
    """
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    placed = counts.select("bucket", (F.sum("n").over(upto) - F.col("n")).alias("before"), F.sum("n").over(upto).alias("upto"), wanted.alias("wanted"))
    holding = placed.filter((F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("upto")))
    return holding.agg(F.max("bucket").alias("bucket"), F.max(F.col("wanted") - F.col("before")).alias("take"))


def exact_split(df: DataFrame, key: str = "id", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` with exactly ceil(n * test_size) test rows: those of the lowest hashes.

    ``key`` must be unique. Hashes are counted by their first four digits, those
    of the bucket that holds the cut by the next four, and only what shares all
    eight, 1 row in 4 billion, is ranked. Keys and hashes are written once.
    """
    digest = key_digest(F.col(key), seed)
    keys = materialize(df.select(F.col(key).alias("__key"), digest.alias("__digest")), "keys")
    first, second = (F.substring("__digest", 1 + k * _DIGITS, _DIGITS) for k in (0, 1))
    wanted = keys.agg(F.ceil(F.round(F.count(F.lit(1)) * F.lit(test_size), 9)).cast("bigint")).scalar()
    outer = _cut(keys, first, wanted)
    inside = keys.filter(first == outer.select("bucket").scalar())
    inner = _cut(inside, second, outer.select("take").scalar())
    few = inside.filter(second == inner.select("bucket").scalar())
    # The cut itself as a value: the hash of the last test row.
    ranked = few.select("__digest", F.row_number().over(Window.orderBy("__digest", "__key")).cast("bigint").alias("rank"))
    last = ranked.filter(F.col("rank") == inner.select("take").scalar()).agg(F.max("__digest").alias("digest"))
    return df.withColumn("split", F.when(digest <= last.scalar(), "test").otherwise("train"))
