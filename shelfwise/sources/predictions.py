"""Writing and reading predictions and records, with lineage."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_run_id(prefix: str, now: datetime.datetime | None = None) -> str:
    """``<prefix>-<UTC time>-<random>``: sorts by time, and no two runs share one. Made once, on the driver."""
    moment = now or datetime.datetime.now(datetime.timezone.utc)
    return f"{prefix}-{moment:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:16]}"


def with_lineage(df: DataFrame, training_run_id: str, batch_run_id: str, model_path: str) -> DataFrame:
    """Stamp each row with the runs and the model it comes from."""
    return df.select(
        F.lit(batch_run_id).alias("batch_run_id"), F.lit(training_run_id).alias("training_run_id"), "*",
        F.lit(model_path).alias("model_path"),
    )


def write_predictions(df: DataFrame, base: str) -> str:
    """Write JSON lines below ``base``, one folder per batch run.

    Writing a run again replaces that run only.
    """
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_run_id").json(base)
    )
    return base


def read_predictions(spark: SparkSession, base: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All stored predictions below ``base``, also those of several runs."""
    return (spark.read.schema(schema) if schema else spark.read).json(base)


def write_record(df: DataFrame, path: str) -> None:
    """Write gate, fetch or registration records as JSON."""
    df.write.mode("overwrite").json(path)
