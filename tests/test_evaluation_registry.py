import datetime
import math

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import labels as L
from shelfwise.operators import evaluation as V
from shelfwise.operators import registry as R

REGISTRY = "resource_name string, display_name string, version bigint, create_time timestamp, uri string, image string, labels map<string,string>"


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "Rating double, prediction double")


def test_metrics_of_three_rows(spark):
    row = V.with_quality(V.regression_metrics(scored(spark, [(4.2, 4.1), (3.8, 3.8), (4.1, 4.5)]))).first()
    assert row.mse == pytest.approx(0.056667, abs=1e-6)
    assert row.rmse == pytest.approx(0.238048, abs=1e-6)
    assert row.mae == pytest.approx(0.166667, abs=1e-6)
    assert row.r2_score == pytest.approx(-0.961538, abs=1e-6)
    assert row.quality_score == pytest.approx(0.285717, abs=1e-6)


def test_constant_target(spark):
    assert V.regression_metrics(scored(spark, [(4.0, 4.0), (4.0, 4.0)])).first().r2_score == 1.0
    assert V.regression_metrics(scored(spark, [(4.0, 4.0), (4.0, 4.5)])).first().r2_score == 0.0
    assert math.isnan(V.regression_metrics(scored(spark, [(4.0, 4.5)])).first().r2_score)


def test_evaluation_records(spark):
    row = V.evaluation_record(scored(spark, [(4.2, 4.1), (3.8, 3.8), (4.1, 4.5)]), {"framework": "x"}).first()
    assert (row.quality_score, row.rmse, row.evaluation_status, row.test_samples) == ("0.2857", "0.238", "completed", "3")
    assert row.framework == "x" and row.error_message is None
    empty = V.evaluation_record(scored(spark, [])).first()
    assert (empty.evaluation_status, empty.error_message, empty.rmse) == ("failed", "Test dataset is empty", None)


def test_contract_errors(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "price_numeric double, Rating double")
    with pytest.raises(ValueError, match="nulls in Rating: 1"):
        V.require_contract(df, ["price_numeric"])
    with pytest.raises(ValueError, match="missing_column in Country"):
        V.require_contract(df.dropna(), ["price_numeric", "Country"])
    with pytest.raises(ValueError, match="empty"):
        V.require_contract(df.filter("false"), ["price_numeric"])
    V.require_contract(df.dropna(), ["price_numeric"])


def test_scoring_check_fails_on_a_wrong_count(spark):
    df = spark.createDataFrame([(2, 4.5), (1, 4.0)], "id bigint, prediction double")
    good = V.scoring_check(df, 2).first()
    assert (good.status, good.sample_prediction, good.error) == ("PASSED", 4.0, None)
    bad = V.scoring_check(df, 3).first()
    assert (bad.status, bad.error) == ("FAILED", "Expected predictions count : 3")


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("label,number", [
    ("0-8750", 0.875), ("0-1234", 0.1234), ("0-0000", 0.0), ("0-9999", 0.9999), ("0-0567", 0.0567), ("0", 0.0), ("x", 0.0),
    ("-0-1234", 0.0),
])
def test_decode(spark, label, number):
    assert one(spark, L.decode_metric_label(F.lit(label))) == number


@pytest.mark.parametrize("text,label", [
    ("0.8500", "0-8500"), ("completed", "completed"), ("COMPLETED", "completed"), ("test.value", "test-value"),
    ("test@value!", "test-value-"), ("x" * 80, "x" * 80),
])
def test_encode_text(spark, text, label):
    assert one(spark, L.encode_text_label(F.lit(text))) == label


def test_invalid_metrics_are_left_out(spark):
    metadata = L.literal_map({"r2_score": "0.875", "rmse": "invalid_number", "mae": "", "evaluation_status": "Completed"})
    labels = one(spark, L.promotion_labels(metadata, "7"))
    assert labels == {
        "ready-for-promotion": "true", "harness-build-id": "7", "env": "prd-test", "r2-score": "0-8750", "eval-status": "completed",
    }


def test_merge_and_budget(spark):
    added, source = L.literal_map({"a": "1", "b": "1"}), L.literal_map({"b": "2", "c": "2"})
    assert one(spark, L.merge_labels(added, source)) == {"a": "1", "b": "2", "c": "2"}
    assert one(spark, L.merge_labels(added, source, {"c": "3"})) == {"a": "1", "b": "2", "c": "3"}
    eleven = L.literal_map({f"k{i}": "v" for i in range(11)})
    both = one(spark, L.budget_labels(eleven, "7"))
    assert both["stored"] == {"ready-for-promotion": "true", "build-id": "7", "environment": "prd-test"}
    assert both["overflow"] == {f"k{i}": "v" for i in range(11)}  # nothing is lost
    few = one(spark, L.budget_labels(added, "7"))
    assert few["stored"] == {"a": "1", "b": "1"} and few["overflow"] == {}


def test_registering_keeps_every_label_and_sign(spark):
    metadata = {"r2_score": "0.9", "rmse": "0.1", "mae": "0.1", "mse": "0.1", "quality_score": "0.9", "evaluation_status": "x" * 80}
    rows = [("m", datetime.datetime(2024, 1, 1), "store/1", "image", metadata), ("m", datetime.datetime(2024, 1, 1), "store/1", "image", metadata),
            (None, datetime.datetime(2024, 1, 1), "store/2", "image", metadata), ("n", datetime.datetime(2024, 1, 1), " ", "image", None)]
    candidates = spark.createDataFrame(rows, "display_name string, create_time timestamp, uri string, image string, metadata map<string,string>")
    known = spark.createDataFrame([], "display_name string, version bigint, resource_name string, create_time timestamp")
    new = R.register_models(candidates, known, "7").collect()
    assert sorted(r.version for r in new) == [1, 2]
    assert all(len(r.labels) == 9 and r.labels["eval-status"] == "x" * 80 for r in new)
    failed = {r.error_message for r in R.failed_registrations(candidates, "7").collect()}
    assert failed == {"candidate has no display name", "candidate has no uri"}


def test_a_model_missing_from_the_source_is_a_failed_record(spark):
    models = spark.createDataFrame([("models/1", "m", "completed", "n/a", "true", "b")], "model_uri string, display_name string, eval_status string, quality_score string, ready_for_promotion string, harness_build_id string")
    refused = R.gate_with_reasons(models, 0.5).first()
    assert not refused.gate_passed and refused.failure_reasons[0] == "quality_score n/a is not a number"
    passed = R.gate_with_reasons(models.withColumn("quality_score", F.lit("0.9")), 0.5)
    source = versions(spark)
    record = R.promote_models(passed, source.filter("false"), source.filter("false"), "a", "b", "2025-01-02").first()
    assert record.promotion_status == "failed" and record.error_message == "source has no model models/1" and record.model_version == ""


def versions(spark):
    def row(number, day, ready):
        labels = {"ready-for-promotion": ready, "quality-score": "0-9970", "eval-status": "completed"}
        return (f"models/{number}", "rating", number, datetime.datetime(2024, 1, day), f"store/{number}", "image", labels)

    return spark.createDataFrame([row(111, 10, "true"), row(222, 20, "True"), row(333, 25, "false")], REGISTRY)


def test_latest_promotable_is_the_newest_ready_one(spark):
    row = R.latest_promotable(versions(spark)).first()
    assert (row.resource_name, row.quality_score, row.harness_build_id) == ("models/222", 0.997, "unknown")


def test_fetch_errors(spark):
    names = spark.createDataFrame([("rating",), ("other",)], "display_name string")
    rows = {r.display_name: r for r in R.fetch_models(versions(spark).filter("version = 333"), names).collect()}
    assert rows["rating"].error_message == "No models with 'ready-for-promotion=true' found among 1 models"
    assert rows["other"].error_message == "No models found with display name: other"
    assert rows["other"].eval_status == "failed" and rows["other"].quality_score == 0.0


@pytest.mark.parametrize("status,score,ready,passes", [
    ("completed", "1.0", "true", True), ("completed", "0.99", "TRUE", True), ("completed", "0.9899", "true", False),
    ("Completed", "1.0", "true", False), ("running", "1.0", "true", False), ("", "1.0", "true", False),
    ("completed", "1.0", "false", False), ("completed", "1.0", None, False), ("completed", "abc", "true", False),
    ("completed", None, "true", False), (None, None, None, False),
])
def test_gate(spark, status, score, ready, passes):
    df = spark.createDataFrame([(status, score, ready)], "s string, q string, r string")
    assert df.select(R.gate_passes(F.col("s"), F.col("q"), F.col("r")).alias("v")).first().v is passes


def test_gate_lists_all_reasons(spark):
    df = spark.createDataFrame([("m", "u", "failed", 0.5, "no", "7")], "display_name string, model_uri string, eval_status string, quality_score double, ready_for_promotion string, harness_build_id string")
    row = R.gate_with_reasons(df, 0.9).first()
    assert not row.gate_passed
    assert row.failure_reasons == [
        "eval_status is failed (required: completed)", "quality_score 0.5000 < 0.9000", "ready_for_promotion is no (required: true)",
    ]


def test_promotion_to_new_and_known_names(spark):
    source = versions(spark)
    gate = R.gate_with_reasons(R.latest_promotable(source), 0.9)
    new = R.promote_models(gate, source, source.filter("false"), "a", "b", "2025-01-02", "9").first()
    assert (new.is_new_model, new.model_version, new.labels["env"]) == (True, "1", "prd-workload")
    assert new.labels["promoted-from"] == "a" and new.labels["eval-status"] == "completed"
    known = R.promote_models(gate, source, source, "a", "b", "2025-01-02", "9", keep_source_env=True).first()
    assert (known.is_new_model, known.model_version, known.target_model_uri) == (False, "334", "models/333")


def test_registering_several_versions(spark):
    rows = [("rating", datetime.datetime(2024, 2, d), f"u{d}", "i", {"r2_score": "0.5", "owner": "x"}) for d in (2, 1)]
    rows.append(("fresh", datetime.datetime(2024, 2, 1), "u", "i", {}))
    new = R.register_models(spark.createDataFrame(rows, "display_name string, create_time timestamp, uri string, image string, metadata map<string,string>"), versions(spark))
    found = {r.uri: r for r in new.collect()}
    assert (found["u1"].version, found["u2"].version, found["u"].version) == (334, 335, 1)
    assert (found["u1"].is_new_model, found["u"].is_new_model) == (False, True)
    assert found["u1"].metadata == {"r2_score": "0.5", "owner": "x", "display_name": "rating", "resource_name": "models/333"}
