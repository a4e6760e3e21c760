"""The model registry as a table.

A registry row is one model version: resource_name, display_name, version,
create_time, uri, image and a map of labels. Every operator works on all
display names at once; where one name may hold a large part of the rows, work
is cut before the shuffle (top-1 limits, counts) or by range (numbering).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.labels import (
    LABEL_LIMIT, budget_labels, decode_metric_label, literal_map, merge_labels, promotion_labels,
)
from shelfwise.operators.ordering import number_rows
from shelfwise.session import materialize

# Label and status texts, and the thresholds in use.
READY_LABEL = "ready-for-promotion"
COMPLETED = "completed"
GATE_THRESHOLD = 0.99
PROMOTION_THRESHOLD = 0.95
GATE_ENVIRONMENT = "prd-workload"
NO_MODELS, NONE_READY = "No models found with display name: ", "No models with 'ready-for-promotion=true' found among "
STATUS_IS, SCORE_IS, READY_IS = "eval_status is ", "quality_score ", "ready_for_promotion is "
WANTS_COMPLETED, WANTS_TRUE = " (required: completed)", " (required: true)"
METRIC_FIELDS = {"quality_score": "quality-score", "mae": "mae", "mse": "mse", "r2_score": "r2-score", "rmse": "rmse"}


def _is_true(column: Column) -> Column:
    return F.coalesce(F.lower(column) == "true", F.lit(False))


def versions_newest_first(registry: DataFrame, display_name: str | None = None) -> DataFrame:
    """Versions, newest first; of one model or of all by name."""
    if display_name is not None:
        return registry.filter(F.col("display_name") == display_name).orderBy(F.desc("create_time"), F.desc("resource_name"))
    return registry.orderBy("display_name", F.desc("create_time"), F.desc("resource_name"))


def latest_promotable(registry: DataFrame) -> DataFrame:
    """Per display name the newest version marked ready, with its metrics read from the labels."""
    newest = Window.partitionBy("display_name").orderBy(F.desc("create_time"), F.desc("resource_name"))
    chosen = (
        registry.filter(_is_true(F.col("labels")[READY_LABEL]))
        .withColumn("place", F.row_number().over(newest)).filter(F.col("place") == 1)
    )
    label = F.col("labels")
    return chosen.select(
        F.col("resource_name").alias("model_uri"), "display_name", "resource_name", "create_time",
        F.coalesce(label["harness-build-id"], F.lit("unknown")).alias("harness_build_id"),
        F.coalesce(label["eval-status"], F.lit("unknown")).alias("eval_status"),
        F.coalesce(label[READY_LABEL], F.lit("false")).alias("ready_for_promotion"),
        *[decode_metric_label(label[name]).alias(field) for field, name in METRIC_FIELDS.items()],
    )


def fetch_models(registry: DataFrame, names: DataFrame) -> DataFrame:
    """One record per requested display name; those without a promotable version carry defaults and an error."""
    wanted = names.select("display_name").distinct()
    counts = registry.groupBy("display_name").agg(F.count(F.lit(1)).alias("versions"))
    found = latest_promotable(registry).drop("create_time")
    none_at_all = F.concat(F.lit(NO_MODELS), F.col("display_name"))
    none_ready = F.concat(F.lit(NONE_READY), F.col("versions").cast("string"), F.lit(" models"))
    missing = F.col("resource_name").isNull()
    return (
        wanted.join(counts, "display_name", "left").join(found, "display_name", "left")
        .select(
            F.coalesce("model_uri", F.lit("")).alias("model_uri"), "display_name",
            F.coalesce("resource_name", F.lit("")).alias("resource_name"),
            F.coalesce("harness_build_id", F.lit("unknown")).alias("harness_build_id"),
            F.coalesce("eval_status", F.lit("failed")).alias("eval_status"),
            F.coalesce("ready_for_promotion", F.lit("false")).alias("ready_for_promotion"),
            *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in METRIC_FIELDS],
            F.when(missing, F.when(F.col("versions").isNull(), none_at_all).otherwise(none_ready)).alias("error_message"),
        )
    )


def gate_passes(status: Column, score: Column, ready: Column, threshold: float = GATE_THRESHOLD) -> Column:
    """Completed, good enough and ready; anything missing or unreadable is a no."""
    enough = score.try_cast("double") >= F.lit(float(threshold))
    return F.coalesce(status == COMPLETED, F.lit(False)) & F.coalesce(enough, F.lit(False)) & _is_true(ready)


def _four(column: Column) -> Column:
    return column.try_cast("decimal(38,4)").cast("string")


def gate_with_reasons(models: DataFrame, threshold: float = PROMOTION_THRESHOLD) -> DataFrame:
    """The gate with every reason for a refusal. A score that is no number counts as 0 and is named as a reason."""
    given = F.col("quality_score").cast("string")
    number = F.col("quality_score").try_cast("double")
    score = F.coalesce(number, F.lit(0.0))
    status = F.coalesce("eval_status", F.lit(""))
    ready = F.coalesce("ready_for_promotion", F.lit("false"))
    limit = F.lit(float(threshold))
    reasons = F.array_compact(F.array(
        F.when(status != COMPLETED, F.concat(F.lit(STATUS_IS), status, F.lit(WANTS_COMPLETED))),
        F.when(given.isNotNull() & number.isNull(), F.concat(F.lit(SCORE_IS), given, F.lit(" is not a number"))),
        F.when(score < limit, F.concat(F.lit(SCORE_IS), _four(score), F.lit(" < "), _four(limit))),
        F.when(~_is_true(ready), F.concat(F.lit(READY_IS), ready, F.lit(WANTS_TRUE))),
    ))
    return models.select(
        (F.size(reasons) == 0).alias("gate_passed"), F.col("display_name").alias("model_name"),
        score.alias("quality_score"), limit.alias("promotion_threshold"), status.alias("eval_status"),
        ready.alias("ready_for_promotion"), F.coalesce("model_uri", F.lit("")).alias("model_uri"), "display_name",
        reasons.alias("failure_reasons"), F.coalesce("harness_build_id", F.lit("unknown")).alias("harness_build_id"),
    )


def _known_models(registry: DataFrame) -> DataFrame:
    """Highest version and parent resource per display name.

    Written out, one row per name: as a plain table it joins by broadcast or with hot names split.
    """
    known = registry.groupBy("display_name").agg(
        F.max("version").alias("last_version"),
        F.max_by("resource_name", F.struct("create_time", "resource_name")).alias("parent"),
    )
    return materialize(known, "known-models")


def register_models(
    candidates: DataFrame, registry: DataFrame, build_number: str = "unknown",
    order_by: Sequence[str] = ("create_time", "uri"),
) -> DataFrame:
    """New registry rows for evaluated models (display_name, create_time, uri, image, metadata map).

    A known name gets the next versions under its existing model, a new name
    starts at 1. Several candidates of a name are numbered in the given order,
    ties by a digest of the whole row (equal rows are interchangeable). The
    metadata and all labels are kept; display and resource name are set by the
    registry. Candidates without a name or a uri are not numbered; see
    ``failed_registrations``.
    """
    usable = candidates.filter(_registrable()).withColumn("tie", _row_digest())
    numbered = number_rows(usable, [*order_by, "tie"], "place", partition_by=["display_name"]).drop("tie")
    labels = promotion_labels(F.col("metadata"), build_number)
    resource = F.coalesce("parent", F.concat(F.lit("models/"), F.col("display_name")))
    own = literal_map({"display_name": F.col("display_name"), "resource_name": resource})
    return (
        numbered.join(_known_models(registry), "display_name", "left")
        .select(
            resource.alias("resource_name"), "display_name",
            (F.coalesce("last_version", F.lit(0)) + F.col("place")).alias("version"),
            "create_time", "uri", "image", labels.alias("labels"),
            merge_labels(F.col("metadata"), own).alias("metadata"),
            F.col("last_version").isNull().alias("is_new_model"),
        )
    )


def _registrable() -> Column:
    return (F.coalesce(F.trim("display_name"), F.lit("")) != "") & (F.coalesce(F.trim("uri"), F.lit("")) != "")


def _row_digest() -> Column:
    return F.xxhash64("display_name", "uri", "image", F.to_json("metadata"))


def failed_registrations(candidates: DataFrame, build_number: str = "unknown") -> DataFrame:
    """A record with status, error and defaults for each candidate that cannot be registered: no name, or no uri."""
    no_name = F.coalesce(F.trim("display_name"), F.lit("")) == ""
    return candidates.filter(~_registrable()).select(
        F.coalesce("display_name", F.lit("")).alias("display_name"), F.coalesce("uri", F.lit("")).alias("uri"),
        F.lit("").alias("resource_name"), F.lit("").alias("model_version"), F.lit(False).alias("is_new_model"),
        F.lit("failed").alias("registration_status"), F.lit(build_number).alias("harness_build_id"),
        F.when(no_name, F.lit("candidate has no display name")).otherwise(F.lit("candidate has no uri")).alias("error_message"),
    )


def default_versions(registry: DataFrame) -> DataFrame:
    """The default version of each display name: the highest."""
    highest = Window.partitionBy("display_name").orderBy(F.desc("version"), F.desc("create_time"), F.desc("resource_name"))
    return registry.withColumn("place", F.row_number().over(highest)).filter(F.col("place") == 1).drop("place")


def promote_models(
    gate: DataFrame, source: DataFrame, target: DataFrame, source_project: str, target_project: str,
    promotion_date: str, build_number: str = "unknown", default_image: str = "unknown", keep_source_env: bool = False,
    promotion_timestamp: str | None = None,
) -> DataFrame:
    """Registration records of the models that passed the gate, one per display name.

    A model that the source no longer has gets a ``failed`` record with the
    error and without a version. What the gate knows of a model is carried in
    ``metadata``.

    Labels of the source win over the added ones. The environment label is set
    to the target's; ``keep_source_env`` leaves the source's, which is what a
    promotion with the older label names does.
    """
    passed = gate.filter("gate_passed")
    details = source.select(
        F.col("resource_name").alias("model_uri"), "uri", F.col("image").alias("source_image"),
        F.col("labels").alias("source_labels"), F.lit(True).alias("found"),
    )
    found = F.coalesce("found", F.lit(False))
    carried = [c for c in passed.columns if c not in ("gate_passed", "failure_reasons")]
    known = [F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in carried]
    metadata = F.map_from_entries(F.filter(F.array(*known), lambda e: e["value"].isNotNull()))
    added = {"promoted-from": source_project, "promotion-date": promotion_date}
    if keep_source_env:
        labels = merge_labels(literal_map({"environment": GATE_ENVIRONMENT, **added}), F.col("source_labels"))
    else:
        labels = merge_labels(
            literal_map({**added, "harness-build-id": build_number}), F.col("source_labels"), {"env": GATE_ENVIRONMENT}
        )
    return (
        passed.withColumn("carried", metadata).join(details, "model_uri", "left").join(_known_models(target), "display_name", "left")
        .select(
            F.col("model_uri").alias("source_model_uri"),
            F.coalesce("parent", F.concat(F.lit("models/"), F.col("display_name"))).alias("target_model_uri"),
            "display_name", F.lit(source_project).alias("source_project"), F.lit(target_project).alias("target_project"),
            F.lit(promotion_date).alias("promotion_date"),
            F.lit(promotion_timestamp or f"{promotion_date}T00:00:00Z").alias("promotion_timestamp"),
            F.when(found, (F.coalesce("last_version", F.lit(0)) + 1).cast("string")).otherwise("").alias("model_version"),
            F.col("last_version").isNull().alias("is_new_model"),
            F.when(found, F.lit("completed")).otherwise("failed").alias("promotion_status"),
            F.when(~found, F.concat(F.lit("source has no model "), "model_uri")).alias("error_message"),
            F.lit(build_number).alias("harness_build_id"), "quality_score", "eval_status",
            F.coalesce("source_image", F.lit(default_image)).alias("container_image"), "uri", labels.alias("labels"),
            F.col("carried").alias("metadata"),
        )
    )


def for_limited_store(registry: DataFrame, build_number: str = "unknown", limit: int = LABEL_LIMIT) -> DataFrame:
    """The registry as a store with room for ``limit`` labels an entry takes it.

    ``labels`` is what such a store gets, ``label_overflow`` what has to be kept in a table beside it; nothing is lost.
    """
    split = registry.withColumn("__split", budget_labels(F.col("labels"), build_number, limit))
    return split.withColumns({"labels": F.col("__split.stored"), "label_overflow": F.col("__split.overflow")}).drop("__split")
