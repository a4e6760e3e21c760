"""Batch job: train on bonus ratings, save, score an input, write, validate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import BATCH_CATEGORICAL_COLUMNS, bonus_rating
from shelfwise.operators.evaluation import present_predictions, result_validation
from shelfwise.operators.features import feature_order
from shelfwise.operators.model import score, train_rating_model
from shelfwise.operators.ordering import number_rows
from shelfwise.plans.preparation import prepare
from shelfwise.sources.models import load_model, save_model
from shelfwise.sources.predictions import new_run_id, read_predictions, with_lineage, write_predictions

# Default price and target name of the batch model.
BATCH_DEFAULT_PRICE = 15.0
BATCH_TARGET = "Quality"


def prepare_batch(df: DataFrame) -> DataFrame:
    return prepare(df, BATCH_CATEGORICAL_COLUMNS, BATCH_DEFAULT_PRICE, rating=False)


def train_batch_model(
    catalog: DataFrame, key: str = "id", seed: int = 42, n_estimators: int = 50, max_depth: int = 12, max_bins: int = 256,
) -> tuple[PipelineModel, list[str]]:
    """Fit on ratings with country and type bonuses and per-row noise; prices stay unscaled."""
    prepared = prepare_batch(catalog)
    rated = prepared.withColumn(
        BATCH_TARGET, bonus_rating(F.col("price_numeric"), F.col("Country"), F.col("Type"), F.col(key), seed)
    )
    features = feature_order(rated, categorical=BATCH_CATEGORICAL_COLUMNS)
    model = train_rating_model(rated, features, BATCH_TARGET, n_estimators, max_depth, max_bins, seed, scale=False)
    return model, features


def score_batch(
    df: DataFrame, model: PipelineModel, features: list[str], training_run_id: str, batch_run_id: str, model_path: str,
    score_name: str = "quality_score", keep: tuple[str, ...] = (), index_by: str | None = None,
) -> DataFrame:
    """Graded predictions with lineage; ``index_by`` adds a 0-based ``input_index`` in that order."""
    prepared = prepare_batch(df)
    if index_by:
        prepared = number_rows(prepared, [index_by], "input_index", start=0)
        keep = (*keep, "input_index")
    graded = present_predictions(score(model, prepared), features, score_name, keep=keep)
    return with_lineage(graded, training_run_id, batch_run_id, model_path)


@dataclass(frozen=True)
class BatchResult:
    model_path: str
    output_path: str
    predictions: DataFrame
    validation: DataFrame


def batch_scoring_job(
    spark: SparkSession, catalog: DataFrame, inputs: DataFrame, model_base: str, output_base: str, key: str = "id",
    seed: int = 42, n_estimators: int = 50, max_depth: int = 12, max_bins: int = 256,
) -> BatchResult:
    """The whole batch run; each run has its own model and output folder."""
    training_run = new_run_id("rating")
    model, features = train_batch_model(catalog, key, seed, n_estimators, max_depth, max_bins)
    path = save_model(spark, model, f"{model_base}/{training_run}", {"run_id": training_run, "features": ",".join(features)})
    loaded, metadata = load_model(spark, path)
    scored = score_batch(
        inputs, loaded, metadata["features"].split(","), metadata["run_id"], new_run_id("batch"), path, keep=(key,)
    )
    output = write_predictions(scored, output_base)
    stored = read_predictions(spark, output, scored.schema)
    return BatchResult(path, output, stored, result_validation(stored))
