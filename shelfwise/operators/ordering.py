"""Row numbers and running totals that never pass through one task.

Rows are range-partitioned by group and order, so a group holding a third of
all rows is cut into many slices. A window then works inside one slice of one
group, and what earlier slices of the group add up to is carried over. A slice
continues at most one group, so the carry table has no more rows than there
are slices and may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize

_SLICE, _CARRY, _PART = "__slice", "__carry", "__part"


def running_total(
    df: DataFrame, order_by: Sequence[str | Column], weight: str | Column, name: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Add the running sum of ``weight`` in the given order, per group.

    The order must be total within a group. The range-partitioned rows are
    written out, because range bounds are sampled anew on every evaluation
    and both passes below have to see the same slices.
    """
    groups = list(partition_by)
    weight = F.col(weight) if isinstance(weight, str) else weight
    ranged = materialize(
        df.withColumn(_PART, weight)
        .repartitionByRange(*groups, *order_by)
        .withColumn(_SLICE, F.spark_partition_id()),
        "ranged",
    )
    earlier = Window.partitionBy(*groups).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ranged.groupBy(_SLICE, *groups).agg(F.sum(_PART).alias(_PART))
        .select(_SLICE, *groups, F.sum(_PART).over(earlier).alias(_CARRY))
        .filter(F.col(_CARRY).isNotNull())
    )
    own = ranged.alias("own")
    carried = F.broadcast(carry.alias("carried"))
    same = F.col(f"own.{_SLICE}") == F.col(f"carried.{_SLICE}")
    for g in groups:
        same = same & F.col(f"own.{g}").eqNullSafe(F.col(f"carried.{g}"))
    upto = Window.partitionBy(_SLICE, *groups).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    return (
        own.join(carried, same, "left")
        .select("own.*", F.coalesce(_CARRY, F.lit(0)).alias(_CARRY))
        .withColumn(name, F.sum(_PART).over(upto) + F.col(_CARRY))
        .select(*df.columns, name)
    )


def number_rows(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "row_number", start: int = 1,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Number rows from ``start`` in a total order, overall or per group.

    Without groups one shuffle does: rows are sorted in their slices before they
    are written, with their place, and the numbers of earlier slices are added.
    """
    if not partition_by:
        ranged = materialize(
            df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
            .withColumn(_SLICE, F.spark_partition_id())
            .withColumn(_PART, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
            "ranged",
        )
        earlier = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
        carry = ranged.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("n")).select(_SLICE, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_CARRY))
        return ranged.join(F.broadcast(carry), _SLICE).select(*df.columns, (F.col(_PART) + F.col(_CARRY) + F.lit(start)).alias(name))
    numbered = running_total(df, order_by, F.lit(1).cast("bigint"), name, partition_by)
    return numbered if start == 1 else numbered.withColumn(name, F.col(name) + F.lit(start - 1))


def ensure_id(df: DataFrame, order_by: Sequence[str | Column] | None = None, name: str = "id") -> DataFrame:
    """Add a 1-based id where the frame has none.

    With an order the id follows it. Without one it follows the input order of
    the files the frame was read from.
    """
    if name in df.columns:
        return df
    if order_by:
        return number_rows(df, order_by, name)
    return number_rows_in_file_order(df, name)


def number_rows_in_file_order(df: DataFrame, name: str = "id", start: int = 1) -> DataFrame:
    """Number the rows of a file scan by file path, then by place in the file.

    ``df`` must come straight from a file reader. Rows of one file block are
    contiguous in their task, so the distance to the first row of the block is
    the place in the block; the table of blocks, one short row each, gives the
    number of rows before it. Files are added up by range, not in one task.
    """
    columns = df.columns
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__place"),
    )
    blocks = placed.groupBy("__file", "__block").agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__place").alias("__first")
    )
    files = blocks.groupBy("__file").agg(F.sum("__rows").alias("__rows"))
    before_block = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    file_offset = running_total(files, ["__file"], "__rows", "__upto").select("__file", (F.col("__upto") - F.col("__rows")).alias("__files_before"))
    offsets = (
        blocks.withColumn("__blocks_before", F.coalesce(F.sum("__rows").over(before_block), F.lit(0)))
        .join(file_offset, "__file")
        .select("__file", "__block", "__first", (F.col("__files_before") + F.col("__blocks_before")).alias("__before"))
    )
    number = F.col("__place") - F.col("__first") + F.col("__before") + F.lit(start)
    return placed.join(offsets, ["__file", "__block"]).select(*columns, number.alias(name))
