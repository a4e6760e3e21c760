"""Training and scoring of rating models."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.features import TARGET, encoding_stages, split_roles
from shelfwise.session import materialize, workers_see_library

PREDICTION = "prediction"
_HELPERS = ("numbers", "numbers_scaled", "features")
_WEIGHT = "__weight"
_ROWS = 500_000  # that a forest is grown from one by one; more are gathered in cells
_TASK_ROWS = 10_000  # of those, in a task at least
_RANK_ERROR = 0.0002


def _cells(rows: DataFrame, features: Sequence[str], target: str, bins: int) -> DataFrame:
    """Rows alike to a forest as one, with their means and ``__weight``, their number.

    Alike are rows of the same categories whose numbers share a bin, of as many
    as the forest has for a number. What target values differ by inside a cell
    adds the same to all sides of a split, so the mean stands for them. A cell
    becomes as many rows of equal weight as leaves about ``_ROWS`` in all, or
    trees that draw their rows would leave too many of few cells out.
    """
    numbers, categories = split_roles(features)
    keys = [F.col(c) for c in categories]
    for c, cuts in zip(numbers, rows.approxQuantile(numbers, [k / bins for k in range(1, bins)], _RANK_ERROR) if numbers else []):
        inner = sorted({x for x in cuts if np.isfinite(x)})
        splits = [float("-inf"), *(inner or [0.0]), float("inf")]
        rows = Bucketizer(splits=splits, inputCol=c, outputCol=f"__bin_{c}", handleInvalid="keep").transform(rows)
        keys.append(F.col(f"__bin_{c}"))
    n = F.count(F.lit(1))
    known = F.when(F.count(target) == n, F.avg(target))  # a missing target stays one, for the forest to refuse
    gathered = rows.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in numbers], known.alias(target), n.alias("__n"))
    cells = materialize(gathered.select(*features, target, "__n"), "cells")
    parts = F.least(F.col("__n"), F.lit(max(1, _ROWS // max(1, cells.count()))).cast("bigint"))
    whole = cells.withColumn("__parts", parts).withColumn("__part", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__parts"))))
    return whole.select(*features, target, (F.col("__n") / F.col("__parts")).alias(_WEIGHT))


def train_rating_model(
    df: DataFrame, features: Sequence[str], target: str = TARGET, n_estimators: int = 50, max_depth: int = 12,
    max_bins: int = 256, seed: int = 42, scale: bool = True,
) -> PipelineModel:
    """Fit a random forest on encoded features; all features compete at each split.

    Encoders are fitted on all rows. More than ``_ROWS`` training rows are
    gathered in weighted cells first, so that what each level of each tree goes
    through does not grow with the rows; none is left out. Rows are dealt out
    evenly, to every core: each level waits for the largest partition.
    """
    if target not in df.columns:
        raise KeyError(f"the training rows have no column {target} to learn")
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=target, predictionCol=PREDICTION, numTrees=n_estimators,
        maxDepth=max_depth, maxBins=max_bins, featureSubsetStrategy="all", seed=seed,
    )
    rows = materialize(df.select(*features, target), "training-rows")
    encoders = Pipeline(stages=encoding_stages(features, scale)).fit(rows)
    given = rows.count()
    if given > _ROWS:
        rows, forest = _cells(rows, features, target, max_bins), forest.setWeightCol(_WEIGHT)
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, 1 + min(given, _ROWS) // _TASK_ROWS)
    grown = forest.fit(encoders.transform(rows.repartition(tasks)))
    return PipelineModel(stages=[*encoders.stages, grown])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction``; the model's helper columns are left out."""
    return model.transform(df).select(*df.columns, PREDICTION)


#: The forms in which a model that exists only as a Python object may take its rows, in the order they are tried.
INPUT_FORMS: dict[str, Callable[[pd.DataFrame], object]] = {
    "named frame": lambda frame: frame,
    "array": lambda frame: frame.to_numpy(),
    "list": lambda frame: frame.to_numpy().tolist(),
}


def predict_rows(model: object, frame: pd.DataFrame, forms: Sequence[str] = tuple(INPUT_FORMS)) -> tuple[np.ndarray, str]:
    """(predictions, form): by the first form that the model takes and that gives one number a row.

    If it takes none, the error names what each of them ended with.
    """
    errors = []
    for form in forms:
        try:
            found = np.asarray(model.predict(INPUT_FORMS[form](frame)), dtype="float64").reshape(-1)
            if len(found) == len(frame):
                return found, form
            errors.append(f"{form}: {len(found)} predictions for {len(frame)} rows")
        except Exception as error:  # whatever an unknown model raises: the next form may do
            errors.append(f"{form}: {type(error).__name__}: {error}")
    raise ValueError("the model takes its rows in no form; " + "; ".join(errors))


def score_python(
    df: DataFrame, load_model: Callable[[], object], features: Sequence[str], batch_rows: int | None = None,
) -> DataFrame:
    """Add ``prediction`` by any Python model with ``predict(frame)``.

    The model is loaded once per Python worker; rows arrive as Arrow batches. It
    gets the features in their order: as a frame with their names, as an array or
    as lists, by the first form it takes (see ``predict_rows``). The form that
    served a batch is tried first for the next one.
    """
    names = list(features)
    workers_see_library(df.sparkSession)

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model, forms = load_model(), list(INPUT_FORMS)
        for batch in batches:
            found, form = predict_rows(model, batch[names], forms)
            forms.sort(key=lambda f: f != form)
            yield pd.Series(found)

    inputs: Column = F.struct(*names)
    return df.withColumn(PREDICTION, predict(inputs))
