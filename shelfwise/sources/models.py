"""Saving and loading fitted models with their metadata."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def save_model(spark: SparkSession, model: PipelineModel, path: str, metadata: Mapping[str, str]) -> str:
    """Save model and metadata below ``path``."""
    model.write().overwrite().save(f"{path}/model")
    text = json.dumps({k: str(v) for k, v in metadata.items()}, sort_keys=True)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    return path


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict[str, str]]:
    """The model and its metadata; a missing one raises ``FileNotFoundError``."""
    try:
        metadata = spark.read.text(f"{path}/metadata").first()
    except AnalysisException as error:
        raise FileNotFoundError(f"there is no model at {path}") from error
    return PipelineModel.load(f"{path}/model"), json.loads(metadata.value)
