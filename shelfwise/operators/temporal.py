"""As-of joins and rolling sums that never hold a key in one task.

Rows are range-partitioned by key and time, so a key with most of the rows is
cut into many slices. What a slice needs from earlier slices of its key is one
row, which is carried over. Rolling sums are differences of running totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.ordering import running_total
from shelfwise.session import materialize

_AT, _SIDE, _SALT, _LEFT, _RIGHT, _SLICE, _CARRY = "__at", "__side", "__salt", "__left", "__right", "__slice", "__carry"


def time_number(df: DataFrame, name: str) -> Column:
    """A time column as a number: microseconds of timestamps, days of dates, numbers as they are."""
    kind = dict(df.dtypes)[name]
    if kind == "timestamp":
        return F.unix_micros(df[name])
    if kind == "timestamp_ntz":  # as if in UTC, whatever the session's zone
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), df[name])
    return F.unix_date(df[name]) if kind == "date" else df[name]


def as_of_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, take: Sequence[str],
    tie_by: Sequence[str] = (), direction: str = "backward", exact: bool = True, within: float | None = None,
    prefix: str = "",
) -> DataFrame:
    """Every left row with the right row of its key that was valid at its time, or nulls.

    That is the latest one at or before it (``direction="forward"``: the first
    one at or after it). ``exact=False`` leaves out right rows of the same
    moment. Of right rows of one moment the largest by ``tie_by`` counts.
    ``within`` drops matches further away: seconds for timestamps, days for
    dates, else the column's unit. The right columns in ``take`` are added, with
    ``prefix``.

    Left rows with a null key or time stay and match nothing; such right rows
    take no part. Repeated left rows stay repeated.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction is backward or forward, not {direction}")
    names = [prefix + c for c in take]
    if clash := set(names) & set(left.columns):
        raise ValueError(f"both sides have {sorted(clash)}: give a prefix")
    sign = 1 if direction == "backward" else -1
    keys, ties = [f"__k{i}" for i in range(len(on))], [f"__t{i}" for i in range(len(tie_by))]
    matched = F.struct(*[right[c].alias(f"r{i}") for i, c in enumerate(take)], F.lit(True).alias("found"))
    rights = right.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in [*on, right_time])).select(
        *[right[c].alias(k) for c, k in zip(on, keys)], (time_number(right, right_time) * sign).alias(_AT), F.lit(0 if exact else 1).alias(_SIDE),
        *[right[c].alias(t) for c, t in zip(tie_by, ties)], F.xxhash64(matched).alias(_SALT), matched.alias(_RIGHT),
    )
    whole = F.struct(*[left[c].alias(f"l{i}") for i, c in enumerate(left.columns)])
    lefts = left.select(
        *[left[c].alias(k) for c, k in zip(on, keys)], (time_number(left, left_time) * sign).alias(_AT), F.lit(1 if exact else 0).alias(_SIDE),
        F.xxhash64(whole).alias(_SALT), whole.alias(_LEFT),
    )
    order = [_AT, _SIDE, *ties, _SALT]
    both = lefts.unionByName(rights, allowMissingColumns=True)
    ranged = materialize(both.repartitionByRange(*keys, *order).withColumn(_SLICE, F.spark_partition_id()), "as-of")

    last = F.max(F.when(F.col(_RIGHT).isNotNull(), F.struct(_AT, *ties, _SALT, _RIGHT)))
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ranged.groupBy(_SLICE, *keys).agg(last.alias(_CARRY)).withColumn(_CARRY, F.last(_CARRY, ignorenulls=True).over(earlier))
        .filter(F.col(_CARRY).isNotNull()).select(_SLICE, *[F.col(k).alias(f"c{k}") for k in keys], F.col(_CARRY)[_AT].alias("__cat"), F.col(_CARRY)[_RIGHT].alias(_CARRY))
    )  # a slice continues at most one key, so no more rows than slices
    upto = Window.partitionBy(_SLICE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = F.last(F.when(F.col(_RIGHT).isNotNull(), F.struct(F.col(_AT).alias("at"), F.col(_RIGHT).alias("row"))), ignorenulls=True).over(upto)
    filled = ranged.withColumn("__inside", inside).filter(F.col(_LEFT).isNotNull()).alias("own")
    same = F.col(f"own.{_SLICE}") == F.col(f"carried.{_SLICE}")
    for k in keys:
        same = same & (F.col(k) == F.col(f"c{k}"))
    joined = filled.join(F.broadcast(carry.alias("carried")), same, "left")
    row, at = F.coalesce("__inside.row", _CARRY), F.coalesce("__inside.at", "__cat")
    valid = F.col(_AT).isNotNull() & row["found"]
    if within is not None:
        unit = 1_000_000 if dict(left.dtypes)[left_time].startswith("timestamp") else 1
        valid = valid & (F.col(_AT) - at <= within * unit)
    return joined.select(
        *[F.col(f"{_LEFT}.l{i}").alias(c) for i, c in enumerate(left.columns)],
        *[F.when(valid, row[f"r{i}"]).alias(n) for i, n in enumerate(names)],
    )


def rolling_sums(df: DataFrame, time: str, before: float, values: dict[str, str | Column], by: Sequence[str] = (), scale: int = 6) -> DataFrame:
    """Add to each row the number of rows, and the sums, of its group from ``before`` earlier up to its own time.

    The frame is SQL's ``RANGE BETWEEN before PRECEDING AND CURRENT ROW``: both ends count, and all rows of a moment.
    ``before`` is in seconds for timestamps, else in the column's unit. ``values`` names the sums; ``n_rows`` counts
    rows, ``<name>_known`` the known values of each. Sums are decimals with ``scale`` digits after the point. Rows with a
    null time have nulls and are in no frame; a null group is a group.

    A frame is the difference of two running totals, of its own moment and of the last one before its start. So no row
    is copied into others' frames, however many there are, and a group with most of the rows spans tasks. (Differences
    of doubles would keep the rounding of all that came before, hence decimals.)
    """
    unit = 1_000_000 if dict(df.dtypes)[time].startswith("timestamp") else 1
    sums = {n: (F.col(v) if isinstance(v, str) else v).cast(f"decimal(28,{scale})") for n, v in values.items()}
    group = F.struct(*[F.col(c) for c in by], F.lit(0).alias("_"))  # never null
    rows = df.withColumns({"__group": group, _AT: time_number(df, time)})
    wide = f"decimal(38,{scale})"
    measures = {"n_rows": F.count(F.lit(1)), **{f"{n}_known": F.count(v) for n, v in sums.items()}, **{n: F.coalesce(F.sum(v), F.lit(0)).cast(wide) for n, v in sums.items()}}
    totals = rows.filter(F.col(_AT).isNotNull()).groupBy("__group", _AT).agg(*[m.alias(f"__{n}") for n, m in measures.items()])
    for n in measures:
        totals = running_total(totals, [_AT], f"__{n}", f"__{n}_upto", ["__group"])
    totals = materialize(totals, "running-totals")
    known = totals.select("__group", F.col(_AT).alias("__at_known"), *[F.col(f"__{n}_upto").alias(f"__{n}_before") for n in measures])
    asked = totals.withColumn("__from", F.col(_AT) - F.lit(before * unit).cast(dict(totals.dtypes)[_AT]))
    framed = as_of_join(asked, known, ["__group"], "__from", "__at_known", [f"__{n}_before" for n in measures], exact=False)
    inside = {n: (F.col(f"__{n}_upto") - F.coalesce(F.col(f"__{n}_before"), F.lit(0))).cast(wide if n in sums else "bigint") for n in measures}
    frames = materialize(framed.select(F.col("__group").alias("__g"), F.col(_AT).alias("__moment"), *[c.alias(n) for n, c in inside.items()]), "frames")
    joined = rows.join(frames, (F.col("__group") == F.col("__g")) & (F.col(_AT) == F.col("__moment")), "left")
    return joined.select(*df.columns, *measures)
