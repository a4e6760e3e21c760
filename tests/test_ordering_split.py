import math

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.explore import boxplot_stats
from shelfwise.operators.ordering import ensure_id, number_rows, running_total
from shelfwise.operators.split import exact_split, hash_split


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_row_numbers_do_not_depend_on_partitions(spark, parts):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(parts)
    rows = number_rows(df, ["k"], "n").collect()
    assert sorted((r.k, r.n) for r in rows) == [(k, k + 1) for k in range(1000)]


def test_running_total_of_a_hot_group_is_cut(spark):
    """Nine rows in ten belong to one group, which still spans several slices."""
    df = spark.range(2000).select(
        "id", F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise("hot").alias("g"), (F.col("id") % 5).alias("w")
    ).repartition(16)
    rows = sorted(running_total(df, ["id"], "w", "total", ["g"]).collect(), key=lambda r: r.id)
    sums = {}
    for r in rows:
        sums[r.g] = sums.get(r.g, 0) + r.w
        assert r.total == sums[r.g]


def test_generated_ids(spark):
    df = spark.createDataFrame([("France", 4.0), ("Italy", 4.5)], "Country string, Rating double")
    assert sorted(r.id for r in ensure_id(df, ["Country"]).collect()) == [1, 2]
    assert ensure_id(spark.range(3)).columns == ["id"]


def test_ids_in_file_order_over_split_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(5000).repartitionByRange(3, "id").sortWithinPartitions("id").selectExpr("id as k", "repeat('x', 50) as t").write.option("header", True).csv(path)
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        rows = ensure_id(spark.read.option("header", True).csv(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep[0])
        spark.conf.set("spark.sql.files.openCostInBytes", keep[1])
    assert len(rows) == 5000 and all(r.id == int(r.k) + 1 for r in rows)


@pytest.mark.parametrize("n,size", [(10, 0.2), (101, 0.2), (1000, 0.33), (3, 0.5)])
def test_exact_split_sizes(spark, n, size):
    counts = {r.split: r.n for r in exact_split(spark.range(n), test_size=size).groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert counts["test"] == math.ceil(n * size) and counts["train"] == n - counts["test"]


def test_splits_are_stable_under_repartition(spark):
    for split in (hash_split, exact_split):
        first = {r.id: r.split for r in split(spark.range(500)).collect()}
        again = {r.id: r.split for r in split(spark.range(500).repartition(13)).collect()}
        assert first == again and set(first.values()) == {"train", "test"}


def test_boxplot_of_one_dominant_category(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).otherwise("hot").alias("Type"),
        (F.col("id") * 7919 % 1009).cast("double").alias("y"),
    )
    exact = {r.category: r for r in boxplot_stats(df, "y", ["Type"]).collect()}
    want = df.groupBy("Type").agg(F.percentile("y", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")).collect()
    assert len(exact) == len(want)
    for r in want:
        found = exact[r.Type]
        assert [found.q1, found.median, found.q3] == pytest.approx(r.q)


def quartiles_of(df):
    return {r.Type: list(r.q) for r in df.groupBy("Type").agg(F.percentile("y", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")).collect()}


def test_boxplot_ranks_a_small_part_of_the_values(spark):
    from shelfwise import session

    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0
    df = spark.range(200_000).select(
        F.when(F.col("id") % 10 == 0, (F.col("id") % 70).cast("string")).when(F.col("id") == 1, "alone").otherwise("hot").alias("Type"),
        (F.pow(draw, F.lit(-2.0)) * F.when(F.col("id") % 2 == 0, 1).otherwise(-1)).alias("y"),
    )
    start = len(session._scratch)
    found = {r.category: [r.q1, r.median, r.q3] for r in boxplot_stats(df, "y", ["Type"]).collect()}
    want = quartiles_of(df)
    assert len(want) == 9 and found == {k: pytest.approx(q) for k, q in want.items()}
    ranked = [p for p in session._scratch[start:] if "/ranged-" in p]
    assert len(ranked) == 1 and spark.read.parquet(ranked[0]).count() < 10_000  # of 200,000


@pytest.mark.parametrize("bounds", [[0.0] * 6, [-1e300, -5.0, 2.0, 2.0, 3.0, 1e300], [float("nan")] * 6])
def test_boxplot_is_exact_whatever_the_sketch_says(spark, monkeypatch, bounds):
    df = spark.range(3000).select((F.col("id") % 4).cast("string").alias("Type"), (F.pmod(F.xxhash64("id"), F.lit(40)) - 20.0).alias("y"))
    want = quartiles_of(df)
    monkeypatch.setattr(F, "percentile_approx", lambda *_: F.any_value(F.array(*[F.lit(b) for b in bounds])))
    stats = {r.category: r for r in boxplot_stats(df, "y", ["Type"]).collect()}
    assert {k: [r.q1, r.median, r.q3] for k, r in stats.items()} == {k: pytest.approx(q) for k, q in want.items()}
    assert all(r.n == 750 and r.n_outliers == 0 and (r.whisker_low, r.whisker_high) == (-20.0, 19.0) for r in stats.values())


def test_job_scratch_is_deleted_and_nothing_else(spark, tmp_path):
    import os

    from shelfwise.session import job_scratch, materialize

    local = lambda df: df.inputFiles()[0].split(":", 1)[1].replace("///", "/")
    before = materialize(spark.range(3), "outer")
    with job_scratch(spark):
        inner = materialize(spark.range(5), "inner")
        inner.write.parquet(str(tmp_path / "result"))
        path = local(inner)
        assert os.path.exists(path)
    assert not os.path.exists(path) and os.path.exists(local(before))
    assert spark.read.parquet(str(tmp_path / "result")).count() == 5 and before.count() == 3
