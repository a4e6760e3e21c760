import datetime
import json

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import linear_rating
from shelfwise.operators.model import score
from shelfwise.operators.requests import clean_requests, explode_requests
from shelfwise.plans.batch import batch_scoring_job, score_batch, train_batch_model
from shelfwise.plans.recommender import recommend, recommender_quality
from shelfwise.plans.report import eda_report
from shelfwise.plans.adapters import items
from shelfwise.plans.training import training_job
from shelfwise.sources import catalog, models, predictions
from shelfwise.streaming.scorer import read_request_stream, score_requests, start_scoring


def test_catalog_paths_and_empty_files(spark, tmp_path):
    for bad in ("", None, "relative.csv"):
        with pytest.raises(ValueError):
            catalog.read_catalog(spark, bad)
    empty = tmp_path / "empty.csv"
    empty.write_text("Country,Rating\n")
    with pytest.raises(ValueError, match="no rows"):
        catalog.read_catalog(spark, str(empty))


def test_catalog_file(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('Country,Price,Rating,Title\nFrance,$25.99,4.5,"say ""hi"", now"\nNA,,n/a,b\n')
    rows = catalog.read_catalog(spark, str(path), number_rows=True).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("France", "$25.99", 4.5, 'say "hi", now', 1), (None, None, None, "b", 2)]


def test_batch_input_formats(spark, tmp_path):
    lines = tmp_path / "b.jsonl"
    lines.write_text('{"Country": "France", "Price": 25.5}\n\n{"Country": null, "Price": "$3"}\n')
    assert [tuple(r) for r in catalog.read_batch_input(spark, str(lines)).collect()] == [("France", "25.5"), (None, "$3")]
    table = tmp_path / "b.csv"
    table.write_text("Country,Price\nItaly,7\n")
    assert [tuple(r) for r in catalog.read_batch_input(spark, str(table)).collect()] == [("Italy", "7")]


def test_run_ids():
    moment = datetime.datetime(2025, 6, 9, 14, 1, 42)
    runs = {predictions.new_run_id("batch", moment) for _ in range(1000)}
    assert len(runs) == 1000 and all(r.startswith("batch-20250609T140142-") for r in runs)


def test_rewriting_a_run_replaces_only_that_run(spark, tmp_path):
    base = str(tmp_path / "out")
    for run, n in (("r1", 3), ("r2", 2), ("r1", 1)):
        predictions.write_predictions(predictions.with_lineage(spark.range(n), "t", run, "m"), base)
    counts = {r.batch_run_id: r["count"] for r in predictions.read_predictions(spark, base).groupBy("batch_run_id").count().collect()}
    assert counts == {"r1": 1, "r2": 2}


def test_missing_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, str(tmp_path / "none"))


DOCUMENTS = [
    '{"instances": [[39.99, "France", "Bordeaux", "Red", "Bold", "Merlot"], [5, null, "X", "White", "Light", "Y"]]}',
    '{"instances": [{"price_numeric": 30.0, "Country": "Italy", "Type": "Red"}]}',
    '{"instances": [["a", "b"]]}', "broken", '{"other": 1}', '{"instances": []}', '{"instances": [7]}',
]


def test_request_forms(spark):
    df = spark.createDataFrame(list(enumerate(DOCUMENTS)), "doc int, value string")
    rows = clean_requests(explode_requests(df, keep=["doc"])).orderBy("doc", "position").collect()
    assert [(r.doc, r.status) for r in rows] == [
        (0, "OK"), (0, "OK"), (1, "OK"), (2, "FAILED"), (3, "FAILED"), (4, "FAILED"), (5, "FAILED"), (6, "FAILED")
    ]
    assert (rows[0].price_numeric, rows[0].Grape) == (39.99, "Merlot")
    assert (rows[1].price_numeric, rows[1].Country) == (5.0, "Unknown")
    assert (rows[2].price_numeric, rows[2].Country, rows[2].Region) == (30.0, "Italy", "Unknown")
    assert rows[3].error == "expected 6 features, got 2"


def test_request_files(spark, tmp_path):
    for i, text in enumerate(DOCUMENTS[:2]):
        (tmp_path / f"{i}.json").write_text(json.dumps(json.loads(text), indent=2))
    assert explode_requests(catalog.read_requests(spark, str(tmp_path))).filter("status = 'OK'").count() == 3


def rate(rows):
    return rows.withColumn("prediction", linear_rating(F.col("price_numeric")))


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    inbox, out, checks, progress = (str(tmp_path / n) for n in ("in", "out", "checks", "progress"))
    (tmp_path / "in").mkdir()
    for i, text in enumerate(DOCUMENTS[:4]):
        (tmp_path / "in" / f"{i}.txt").write_text(text.replace("[", "[\n  ").replace(",", ",\n  ") + "\n")  # indented, as they are sent
    for _ in range(2):  # the second start finds nothing new
        stream = score_requests(read_request_stream(spark, inbox, 2), rate)
        start_scoring(stream, out, progress, checks).awaitTermination()
    columns = ["position", "prediction", "quality_grade", "status", "error"]
    got = sorted(map(str, spark.read.parquet(out).select(columns).collect()))
    want = sorted(map(str, score_requests(catalog.read_requests(spark, inbox), rate).select(columns).collect()))
    assert got == want
    records = spark.read.parquet(checks).collect()
    assert len(records) == 2 and sum(r.predictions_count for r in records) == 3


def test_jobs_on_a_small_catalog(spark, small, tmp_path):
    rows = items(spark, small)
    result = training_job(rows, n_estimators=5, max_depth=6, max_bins=32, model_path=str(tmp_path / "m"))
    record = result.evaluation.first()
    assert float(record.r2_score) > 0.98 and record.evaluation_status == "completed"
    assert {r.split for r in result.fit.collect()} == {"train", "test"}
    model, metadata = models.load_model(spark, str(tmp_path / "m"))
    assert metadata["quality_score"] == record.quality_score
    unseen = spark.createDataFrame([(20.0, "Nowhere", "R", "T", "S", "G")], "price_numeric double, Country string, Region string, Type string, Style string, Grape string")
    assert 3.0 <= score(model, unseen).first().prediction <= 5.0

    batch = batch_scoring_job(spark, rows, rows, str(tmp_path / "models"), str(tmp_path / "scores"), n_estimators=5, max_depth=5, max_bins=32)
    check = batch.validation.first()
    assert check.n == rows.count() and 3.0 <= check.min_score <= check.max_score <= 5.0
    assert check.summary == f"Batch {check.batch_run_id}: {check.n} predictions validated"


def test_batch_rows_carry_inputs_and_index(spark, small):
    rows = items(spark, small)
    model, features = train_batch_model(rows, n_estimators=2, max_depth=3, max_bins=32)
    scored = score_batch(rows, model, features, "t", "b", "m", index_by="id")
    first = scored.orderBy("input_index").first()
    assert features == ["price_numeric", "Country", "Type", "Grape", "Style"]
    assert first.input_index == 0 and isinstance(first.input_price_numeric, str) and first.training_run_id == "t"


def test_report_and_recommender(spark, small):
    rows = items(spark, small)
    tables = eda_report(rows)
    assert tables["shape"].first().n_columns == 9
    assert all(t.columns for t in tables.values())
    lists = recommend(rows, 3, rows.select("id").limit(4))
    assert lists.groupBy("id").count().filter("count = 3").count() == 4
    assert recommender_quality(rows, gate=0.5).first().gate_passed
