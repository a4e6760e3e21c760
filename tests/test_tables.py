"""Sketch tables, binned density, category tables, input forms of opaque models, failed records."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import cubes as C
from shelfwise.operators import explore as E
from shelfwise.operators import sketches as K
from shelfwise.operators.encoding import category_table, encode_categories, hash_features, one_hot_by_table
from shelfwise.operators.features import one_hot
from shelfwise.operators.model import predict_rows, score_python, train_rating_model
from shelfwise.plans.adapters import items
from shelfwise.plans.training import EvaluationFailed, training_job


@pytest.fixture(scope="module")
def sales(spark):
    """Two thirds of the rows on one day."""
    draw = random.Random(1)
    rows = [("hot" if draw.random() < 2 / 3 else f"d{draw.randrange(9)}", draw.lognormvariate(0, 2) if draw.random() > 0.02 else None, draw.randrange(4000)) for _ in range(30_000)]
    return spark.createDataFrame(rows, "day string, price double, user int").repartition(6).cache()


def test_merged_sketches_are_within_their_errors(spark, sales, tmp_path):
    path = str(tmp_path / "s")
    for part in ("day = 'hot'", "day <> 'hot'", "day = 'd3'"):  # the last one replaces what is there
        K.write_sketches(K.build_sketches(sales.filter(part), ["day"], ["price"], ["user"]), path, "day")
    stored = K.read_sketches(spark, path)
    assert stored.count() == 10
    merged = {r["column"]: r for r in K.sketch_report(K.merge_sketches(stored), quantiles=(0.1, 0.5, 0.99)).collect()}
    once = {r["column"]: r for r in K.sketch_report(K.build_sketches(sales, [], ["price"], ["user"]), quantiles=(0.1, 0.5, 0.99)).collect()}
    frame = sales.toPandas()
    known = frame["price"].dropna().sort_values().to_numpy()
    users = frame["user"].nunique()
    for report in (merged, once):
        price = report["price"]
        assert (price["rows"], price["known"], price["least"], price["largest"]) == (30_000, len(known), known[0], known[-1])
        for q, name in ((0.1, "q10"), (0.5, "q50"), (0.99, "q99")):
            assert abs((known <= price[name]).mean() - q) <= K.RANK_ERROR + 1 / len(known)
        assert abs(report["user"]["distinct"] - users) <= K.DISTINCT_ERROR * users
    assert merged["user"]["distinct"] == once["user"]["distinct"]  # distinct sketches merge without loss


def test_sketches_of_nothing(spark, sales):
    none = K.build_sketches(sales.withColumn("price", F.lit(None).cast("double")), ["day"], ["price"], ["user"])
    row = K.sketch_report(K.merge_sketches(none)).filter("column = 'price'").first()
    assert (row["rows"], row["known"], row["q50"]) == (30_000, 0, None)
    assert K.merge_sketches(none.limit(0)).first()["rows"] == 0


@pytest.mark.parametrize("column", ["price", "user"])
def test_binned_density_is_within_its_error(spark, sales, column):
    exact = {r["position"]: r for r in E.density_curve(sales, column).collect()}
    stats = sales.agg(F.count(column).alias("n"), F.stddev_samp(column).alias("s")).first()
    h = stats["n"] ** -0.2 * stats["s"]
    peak = 1 / (h * math.sqrt(2 * math.pi))
    for accuracy in (1e-2, 1e-4):
        found = E.binned_density(sales, column, accuracy=accuracy).collect()
        assert len(found) == E.GRID
        worst = max(abs(r["density"] - exact[r["position"]]["density"]) for r in found)
        assert worst <= accuracy * peak
        assert all(r["x"] == pytest.approx(exact[r["position"]]["x"]) for r in found)
        assert sum(r["density"] for r in found) > 0


def test_binned_density_without_spread_or_values(spark):
    for values in ([], [None], [3.0], [3.0, 3.0]):
        assert E.binned_density(spark.createDataFrame([(v,) for v in values], "v double"), "v").count() == 0


CATEGORIES = [(i, ["b", "a", "c", None, "a", "x y"][i % 6], "only" if i % 2 else None, float(i)) for i in range(40)]


def test_vectors_by_the_table_are_the_indexer_s(spark):
    df = spark.createDataFrame(CATEGORIES, "id int, k string, m string, v double").fillna("none", ["k", "m"])
    some = df.filter("k <> 'c'")
    table = category_table(some, ["k", "m"], order="alphabet")
    one = {r["id"]: r["features"] for r in one_hot_by_table(df, table, ["k", "m"]).collect()}
    two = {r["id"]: r["features"] for r in one_hot(df, some, ["k", "m"]).collect()}
    assert one == two and any(v.numNonzeros() == 1 for v in one.values())


def test_category_positions(spark):
    df = spark.createDataFrame(CATEGORIES, "id int, k string, m string, v double")
    table = category_table(df, ["k", "m"])
    assert [(r["category"], r["position"]) for r in table.filter("feature = 'k'").orderBy("position").collect()] == [("a", 0), ("b", 1), ("c", 2), ("x y", 3)]
    new = spark.createDataFrame([(1, "zzz", None, 0.0), (2, None, "only", 0.0), (3, "c", "only", 0.0)], df.schema)
    assert [(r["k_position"], r["m_position"]) for r in encode_categories(new, table, ["k", "m"]).orderBy("id").collect()] == [(None, None), (None, 0), (2, 0)]
    assert [r["features"].numNonzeros() for r in one_hot_by_table(new, table, ["k", "m"], numeric=["v"]).orderBy("id").collect()] == [0, 1, 2]
    assert encode_categories(df, table.limit(0), ["k"]).filter("k_position is null").count() == 40
    assert hash_features(df.fillna("none"), ["k", "m"], 64).first()["features"].size == 64
    with pytest.raises(ValueError, match="frequency"):
        category_table(df, ["k"], order="none")


def loader(takes):
    def load():
        class Model:
            def predict(self, rows):
                if type(rows).__name__ != takes:
                    raise TypeError(f"no {type(rows).__name__}")
                values = rows.to_numpy() if takes == "DataFrame" else rows
                return [float(r[0]) + len(r[1]) for r in values]

        return Model()

    return load


@pytest.mark.parametrize("takes,form", [("DataFrame", "named frame"), ("ndarray", "array"), ("list", "list")])
def test_opaque_models_take_their_own_form(spark, takes, form):
    frame = pd.DataFrame({"a": [1.5, 2.0], "b": ["xy", ""]})
    found, used = predict_rows(loader(takes)(), frame)
    assert used == form and found.tolist() == [3.5, 2.0]
    df = spark.createDataFrame([(1.5, "xy"), (2.0, "")], "a double, b string")
    assert sorted(r["prediction"] for r in score_python(df, loader(takes), ["a", "b"]).collect()) == [2.0, 3.5]


def test_a_model_that_takes_no_form_says_why():
    with pytest.raises(ValueError, match="named frame: TypeError: no DataFrame; array: TypeError: no ndarray; list: TypeError: no list"):
        predict_rows(loader("other")(), pd.DataFrame({"a": [1.0], "b": ["x"]}))

    class Short:
        def predict(self, rows):
            return [1.0]

    with pytest.raises(ValueError, match="1 predictions for 2 rows"):
        predict_rows(Short(), pd.DataFrame({"a": [1.0, 2.0]}))


def test_training_without_its_target_is_refused(spark):
    with pytest.raises(KeyError, match="Rating"):
        train_rating_model(spark.range(3).select(F.col("id").alias("price_numeric")), ["price_numeric"])


def test_training_job_records_a_failed_evaluation(spark, small, tmp_path):
    none = items(spark, small).filter("id < 0")
    with pytest.raises(EvaluationFailed) as failed:
        training_job(none, model_path=str(tmp_path / "m"))
    record = failed.value.evaluation.first()
    assert (record["evaluation_status"], record["test_samples"], record["quality_score"], record["target"]) == ("failed", "0", None, "Rating")
    assert record["error_message"] == str(failed.value)
    assert spark.read.json(str(tmp_path / "m" / "evaluation")).first()["evaluation_status"] == "failed"


def test_cubes_by_hand(spark):
    rows = [("a", "x", 1, "p"), ("a", "x", 2, "q"), ("a", None, 3, "p"), (None, "x", 4, None), (None, None, 5, "p"), ("b", "y", 6, "p")]
    df = spark.createDataFrame(rows, "g string, h string, v int, w string")
    for exact in (True, False):
        found = C.totals_by(df, ["g", "h"], C.cube_sets(["g", "h"]), {"n": F.count(F.lit(1)), "s": F.sum("v")}, ["w", "g"], exact)
        got = {(r["g"], r["h"], r["level"]): (r["n"], r["s"], r["w_distinct"], r["g_distinct"]) for r in found.collect()}
        assert len(got) == 5 + 3 + 3 + 1
        assert got["a", "x", 0] == (2, 3, 2, 1) and got["a", None, 0] == (1, 3, 1, 1) and got["a", None, 1] == (3, 6, 2, 1)
        assert got[None, None, 0] == (1, 5, 1, 0) and got[None, None, 1] == (2, 9, 1, 0) and got[None, "x", 2] == (3, 7, 2, 1)
        assert got[None, None, 3] == (6, 21, 2, 2)
    assert [(r["level"], r["n"]) for r in C.totals_by(df, ["g", "h"], [["h"], ["h"]], {"n": F.count(F.lit(1))}).orderBy("n").collect()] == [(2, 1), (2, 2), (2, 3)]
    with pytest.raises(ValueError, match="besides"):
        C.totals_by(df, ["g"], [["z"]], {})


def test_sketched_cubes_shuffle_once_and_stay_within_their_error(spark, sales):
    found = C.totals_by(sales, ["day"], C.rollup_sets(["day"]), {"n": F.count(F.lit(1))}, ["user"], exact=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Expand") == 1
    exact = {(r["day"], r["level"]): r for r in C.totals_by(sales, ["day"], C.rollup_sets(["day"]), {"n": F.count(F.lit(1))}, ["user"]).collect()}
    rows = found.collect()
    assert len(rows) == len(exact) == 11
    for r in rows:
        true = exact[r["day"], r["level"]]
        assert r["n"] == true["n"] and abs(r["user_distinct"] - true["user_distinct"]) <= K.DISTINCT_ERROR * true["user_distinct"] + 1


def test_many_training_rows_are_gathered_in_weighted_cells(spark, monkeypatch):
    """All rows count, by weight; the forest predicts as one grown from every row."""
    from shelfwise.operators import model as M

    rows = spark.range(6000).select(
        (F.col("id") * 7919 % 1000 / 10).alias("price_numeric"), F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("Country"),
    ).withColumn("Rating", 3.0 + F.col("price_numeric") * 0.015 + F.length("Country") * 0.1 + F.ascii(F.substring("Country", 2, 1)) * 0.05)
    plain = M.score(M.train_rating_model(rows, ["price_numeric", "Country"], n_estimators=10, max_bins=32), rows)
    monkeypatch.setattr(M, "_ROWS", 400)
    cells = M._cells(rows, ["price_numeric", "Country"], "Rating", 32)
    sums = cells.agg(F.count(F.lit(1)).alias("n"), F.sum("__weight").alias("w"), F.sum(F.col("__weight") * F.col("Rating")).alias("t")).first()
    assert sums.n <= 400 and abs(sums.w - 6000) < 1e-6
    assert abs(sums.t - rows.agg(F.sum("Rating")).first()[0]) < 1e-6
    few = M.score(M.train_rating_model(rows, ["price_numeric", "Country"], n_estimators=10, max_bins=32), rows)
    error = lambda df: df.agg(1 - F.avg((F.col("Rating") - F.col("prediction")) ** 2) / F.var_pop("Rating")).first()[0]
    assert error(plain) > 0.99 and error(few) > 0.99
