"""Scoring a stream of request documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.functions.cleaning import quality_grade
from shelfwise.operators.evaluation import scoring_check
from shelfwise.operators.model import PREDICTION
from shelfwise.operators.requests import REQUEST_ORDER, clean_requests, explode_requests


def read_request_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of (value, path) from a folder of request documents, one file each, as ``read_requests`` reads them."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))


def score_requests(
    requests: DataFrame, score_rows: Callable[[DataFrame], DataFrame], value: str = "value",
    features: Sequence[str] = REQUEST_ORDER, keep: Sequence[str] = (),
) -> DataFrame:
    """Explode, clean, score and grade request documents; the same for batch and stream.

    ``score_rows`` adds ``prediction``. Unreadable requests stay as FAILED rows.
    """
    rows = clean_requests(explode_requests(requests, value, features, keep), features)
    ok = F.col("status") == "OK"
    return score_rows(rows).select(
        *keep, "position", F.when(ok, F.col(PREDICTION)).alias(PREDICTION),
        F.when(ok, quality_grade(F.col(PREDICTION))).alias("quality_grade"), "status", "error",
    )


def start_scoring(
    scored: DataFrame, output: str, checkpoint: str, checks: str | None = None, trigger: dict | None = None,
    order_by: Sequence[str] = ("position",),
) -> StreamingQuery:
    """Write a scored stream as Parquet, each micro-batch with its validation record.

    Both are written under the number of the micro-batch, so a batch that is run
    again after a failure replaces its own rows and nothing doubles. ``order_by``
    (document, position) says which prediction is the record's sample.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch_id", F.lit(batch_id))
        rows = numbered.persist() if checks else numbered
        dynamic = {"partitionOverwriteMode": "dynamic"}
        rows.write.mode("overwrite").options(**dynamic).partitionBy("batch_id").parquet(output)
        if checks:
            record = scoring_check(rows, order_by=order_by, by=["batch_id"])
            record.write.mode("overwrite").options(**dynamic).partitionBy("batch_id").parquet(checks)
            rows.unpersist()

    writer = scored.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    return writer.foreachBatch(write).start()
