"""Training job: prepare, split, fit, evaluate, branch, save, register."""

from __future__ import annotations

import ast
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shelfwise.operators.evaluation import (
    QUALITY_THRESHOLD, evaluation_record, failed_evaluation, fit_report, pass_threshold, require_contract,
)
from shelfwise.operators.features import TARGET, feature_order
from shelfwise.operators.model import score, train_rating_model
from shelfwise.operators.registry import register_models
from shelfwise.operators.split import hash_split
from shelfwise.plans.preparation import prepare
from shelfwise.session import materialize
from shelfwise.sources.models import load_model, save_model


@dataclass(frozen=True)
class TrainingResult:
    model: PipelineModel
    features: list[str]
    evaluation: DataFrame
    fit: DataFrame
    registered: DataFrame | None


class EvaluationFailed(ValueError):
    """A model could not be evaluated; ``evaluation`` is the failed record."""

    def __init__(self, error: Exception, evaluation: DataFrame) -> None:
        super().__init__(str(error))
        self.evaluation = evaluation


def training_job(
    catalog: DataFrame, key: str = "id", test_size: float = 0.2, seed: int = 42, n_estimators: int = 50,
    max_depth: int = 12, max_bins: int = 256, threshold: float = QUALITY_THRESHOLD,
    registry: DataFrame | None = None, display_name: str = "rating", model_path: str | None = None,
    image: str = "unknown", build_number: str = "unknown",
) -> TrainingResult:
    """Train and evaluate a rating model on a catalog.

    Below the threshold ``registered`` is empty. Where the test rows don't allow
    an evaluation, nothing is trained: ``EvaluationFailed`` carries the failed
    record, which is also written to ``<model_path>/evaluation``. The split rows are kept on
    memory and disk for the passes of the forest; they are rebuilt from the
    source where an executor is lost.
    """
    spark = catalog.sparkSession
    prepared = prepare(catalog)
    features = feature_order(prepared)
    rows = hash_split(prepared.select(key, *features, TARGET), key, test_size, seed).persist(StorageLevel.MEMORY_AND_DISK)
    test = rows.filter(F.col("split") == "test")
    metadata = {"framework": "pyspark.ml", "feature_order": str(features), "target": TARGET}
    try:
        require_contract(test, features)
    except ValueError as error:
        record = materialize(failed_evaluation(str(error), spark, metadata), "evaluation")
        if model_path:
            record.write.mode("overwrite").json(f"{model_path}/evaluation")
        rows.unpersist()
        raise EvaluationFailed(error, record) from error
    model = train_rating_model(
        rows.filter(F.col("split") == "train"), features, n_estimators=n_estimators, max_depth=max_depth,
        max_bins=max_bins, seed=seed,
    )
    evaluation = materialize(evaluation_record(score(model, test), metadata), "evaluation")
    report = materialize(fit_report(score(model, rows)), "fit")
    if model_path:
        save_model(spark, model, model_path, {**metadata, **evaluation.drop("error_message").first().asDict()})
    registered = None
    if registry is not None:
        passed = pass_threshold(evaluation, threshold)
        names = [c for c in evaluation.columns if c != "error_message"]
        entries = [F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in names]
        candidate = passed.select(
            F.lit(display_name).alias("display_name"), F.current_timestamp().alias("create_time"),
            F.lit(model_path or "").alias("uri"), F.lit(image).alias("image"),
            F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull())).alias("metadata"),
        )
        registered = register_models(candidate, registry, build_number)
    rows.unpersist()
    return TrainingResult(model, features, evaluation, report, registered)


def evaluate_stored_model(spark: SparkSession, path: str, data: DataFrame) -> DataFrame:
    """Evaluate a saved model on given rows by its stored feature order and target: one record, completed or failed.

    Missing columns, null targets and empty data give a ``failed`` record with the error; nothing is raised for them.
    """
    model, metadata = load_model(spark, path)
    features, target = ast.literal_eval(metadata["feature_order"]), metadata["target"]
    carried = {k: metadata[k] for k in ("framework", "feature_order", "target")}
    missing = [c for c in [*features, target] if c not in data.columns]
    if missing:
        return failed_evaluation("Missing columns: " + ", ".join(missing), spark, carried)
    nulls = data.agg(F.count_if(F.col(target).isNull())).first()[0]
    if nulls:
        return failed_evaluation(f"Target column '{target}' has {nulls} null values", spark, carried)
    return evaluation_record(score(model, data.select(*features, target)), carried, target)
