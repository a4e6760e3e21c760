"""Model evaluation: metrics, quality scores, checks and records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import quality_grade
from shelfwise.operators.features import TARGET
from shelfwise.operators.model import PREDICTION

# Rating scale, score weights and the threshold of the quality branch.
MAX_RATING = 5.0
R2_WEIGHT, RMSE_WEIGHT = 0.7, 0.3
# Texts in records of results that readers of such records know.
NO_TEST_ROWS = "Test dataset is empty"
WANTED_COUNT = "Expected predictions count : "

QUALITY_THRESHOLD = 0.6
METRICS = ("mse", "rmse", "mae", "r2_score")


def _clamp(column: Column, low: float = 0.0, high: float | None = 1.0) -> Column:
    raised = F.greatest(column, F.lit(low))
    return raised if high is None else F.least(raised, F.lit(high))


def regression_metrics(
    df: DataFrame, target: str = TARGET, prediction: str = PREDICTION, by: Sequence[str] = (), extra: Sequence[Column] = (),
) -> DataFrame:
    """n, mse, rmse, mae and r2_score, and ``extra`` aggregates by name, in one aggregation, overall or per group."""
    error = F.col(target) - F.col(prediction)
    sums = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(target).alias("spread"),
        *extra,
    )
    r2 = (
        F.when(F.col("n") < 2, F.lit(float("nan")))
        .when(F.col("spread") > 0, F.lit(1.0) - F.try_divide("mse", "spread"))
        .when(F.col("mse") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    more = [c for c in sums.columns if c not in {*by, "n", "mse", "mae", "spread"}]
    return sums.select(*by, "n", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2_score"), *more)


def quality_score(r2: Column, rmse: Column, max_rating: float = MAX_RATING) -> Column:
    """Weighted R² and scaled error, within 0 and 1."""
    closeness = _clamp(F.lit(1.0) - rmse / F.lit(max_rating), high=None)
    return _clamp(_clamp(r2) * F.lit(R2_WEIGHT) + closeness * F.lit(RMSE_WEIGHT))


def quality_score_legacy(r2: Column, rmse: Column) -> Column:
    """The older score: unscaled error, no upper bound."""
    return _clamp(r2, high=None) * F.lit(R2_WEIGHT) + _clamp(F.lit(1.0) - rmse, high=None) * F.lit(RMSE_WEIGHT)


def with_quality(metrics: DataFrame, max_rating: float = MAX_RATING) -> DataFrame:
    return metrics.withColumn("quality_score", quality_score(F.col("r2_score"), F.col("rmse"), max_rating))


def _plain_text(number: Column) -> Column:
    """Four decimals without exponent or trailing zeros."""
    return F.regexp_replace(F.round(number, 4).try_cast("decimal(38,4)").cast("string"), r"(\.\d+?)0+$", "$1")


def evaluation_record(
    df: DataFrame, metadata: Mapping[str, str] | None = None, target: str = TARGET, prediction: str = PREDICTION,
) -> DataFrame:
    """One row: carried metadata, metrics to four decimals as text, status, sample count.

    No rows to evaluate give a ``failed`` record with the error.
    """
    scored = with_quality(regression_metrics(df, target, prediction)).withColumn(
        "rmse_normalized", F.col("rmse") / F.lit(MAX_RATING)
    )
    ok = F.col("n") > 0
    carried = [F.lit(v).alias(k) for k, v in (metadata or {}).items()]
    texts = [
        F.when(ok, _plain_text(F.col(c))).alias(c)
        for c in ("quality_score", "r2_score", "rmse", "mae", "mse", "rmse_normalized")
    ]
    return scored.select(
        *carried, *texts,
        F.when(ok, F.lit("completed")).otherwise(F.lit("failed")).alias("evaluation_status"),
        F.col("n").cast("string").alias("test_samples"),
        F.when(~ok, F.lit(NO_TEST_ROWS)).alias("error_message"),
    )


def pass_threshold(evaluated: DataFrame, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Keep evaluated models that reach the threshold."""
    return evaluated.filter(F.col("quality_score").try_cast("double") >= F.lit(threshold))


def data_contract(df: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    """One row per finding: check, column, severity, n.

    Missing columns are seen without reading data; row and null counts come from
    one aggregation.
    """
    have = set(df.columns)
    known = [c for c in [*features, target] if c in have]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in known]
    )

    def finding(check: str, column: str, severity: str, n: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"), F.lit(column).alias("column"),
            F.when(n > 0, F.lit(severity)).otherwise(F.lit("ok")).alias("severity"), n.cast("bigint").alias("n"),
        )

    findings = [finding("empty", "*", "error", F.when(F.col("rows") == 0, 1).otherwise(0))]
    for c in [*features, target]:
        findings.append(finding("missing_column", c, "error", F.lit(0 if c in have else 1)))
    for c in known:
        findings.append(finding("nulls", c, "error" if c == target else "warning", F.col(f"null_{c}")))
    return counts.select(F.inline(F.array(*findings)))


def require_contract(df: DataFrame, features: Sequence[str], target: str = TARGET) -> None:
    """Raise on the first error of the contract (at most a few dozen findings are read)."""
    errors = data_contract(df, features, target).filter(F.col("severity") == "error").collect()
    if errors:
        raise ValueError("; ".join(f"{e.check} in {e.column}: {e.n}" for e in errors))


def present_predictions(
    scored: DataFrame, features: Sequence[str], score_name: str = "quality_score", prediction: str = PREDICTION,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rounded score, grade of the unrounded one, and every input as text."""
    return scored.select(
        *keep,
        F.round(prediction, 2).alias(score_name),
        quality_grade(F.col(prediction)).alias("quality_grade"),
        *[F.col(f).cast("string").alias(f"input_{f}") for f in features],
    )


def result_validation(
    predictions: DataFrame, score_name: str = "quality_score", expected: DataFrame | None = None,
) -> DataFrame:
    """Per batch run: count, score range, summary text and error; no rows at all give one error row.

    ``expected`` (batch_run_id) names the runs there should be: one without rows gets an error row of its own.
    """
    summary = predictions.groupBy("batch_run_id").agg(
        F.min("training_run_id").alias("training_run_id"),
        F.count(F.lit(1)).alias("n"),
        F.min(score_name).alias("min_score"),
        F.max(score_name).alias("max_score"),
    )
    if expected is None:
        some = predictions.groupBy().agg(F.count(F.lit(1)).alias("rows"))
        summary = some.filter("rows = 0").select("rows").join(summary.limit(0), F.lit(True), "left").drop("rows").unionByName(summary)
    else:
        named = expected.select(F.col("batch_run_id").alias("named")).distinct()
        summary = named.join(summary, F.col("named").eqNullSafe(F.col("batch_run_id")), "full").withColumn("batch_run_id", F.coalesce("batch_run_id", "named")).drop("named")
    summary = summary.withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    text = F.concat(
        F.lit("Batch "), F.coalesce("batch_run_id", F.lit("unknown")), F.lit(": "), F.col("n").cast("string"),
        F.lit(" predictions validated"),
    )
    return summary.withColumn("summary", text).withColumn("error", F.when(F.col("n") == 0, F.lit("no predictions to validate")))


def scoring_check(
    scored: DataFrame, expected: int | Column | None = None, order_by: str | Sequence[str] = "id", prediction: str = PREDICTION,
    by: Sequence[str] = (),
) -> DataFrame:
    """One record: instances, predictions made, the first of them, PASSED or FAILED.

    Without ``expected`` every instance is expected to have a prediction.
    Several ``order_by`` columns make the first prediction a definite one.
    """
    place = F.struct(*([order_by] if isinstance(order_by, str) else order_by), prediction)
    made = F.col(prediction).isNotNull() & ~F.isnan(prediction)
    counts = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("test_instances_count"),
        F.count_if(made).alias("predictions_count"),
        F.min_by(prediction, F.when(made, place)).alias("sample_prediction"),
    )
    wanted = F.col("test_instances_count") if expected is None else (
        F.lit(expected) if isinstance(expected, int) else expected
    )
    passed = (F.col("predictions_count") == wanted) & (F.col("predictions_count") > 0)
    return (
        counts.withColumn("status", F.when(passed, "PASSED").otherwise("FAILED"))
        .withColumn("error", F.when(~passed, F.concat(F.lit(WANTED_COUNT), wanted.cast("string"))))
    )


def fit_report(df: DataFrame, target: str = TARGET, prediction: str = PREDICTION) -> DataFrame:
    """Error, R² and target range of train and test side by side."""
    ranges = [F.min(target).alias("target_min"), F.max(target).alias("target_max")]
    metrics = regression_metrics(df, target, prediction, by=["split"], extra=ranges)
    return metrics.select("split", "n", "rmse", "r2_score", "target_min", "target_max")


def failed_evaluation(error: str, spark: SparkSession, metadata: Mapping[str, str] | None = None) -> DataFrame:
    """A ``failed`` evaluation record of the same columns as ``evaluation_record``."""
    none = F.lit(None).cast("string")
    return spark.range(1).select(
        *[F.lit(v).alias(k) for k, v in (metadata or {}).items()],
        *[none.alias(c) for c in ("quality_score", "r2_score", "rmse", "mae", "mse", "rmse_normalized")],
        F.lit("failed").alias("evaluation_status"), F.lit("0").alias("test_samples"), F.lit(error).alias("error_message"),
    )
