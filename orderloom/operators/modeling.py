"""Model selection on chronological folds and the frozen test forecast, on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from orderloom.constants import CELL_KEYS, CV_FOLDS, MODEL_COLUMNS, MODEL_FEATURES
from orderloom.functions.numeric import ratio
from orderloom.operators import boosting
from orderloom.operators.boosting import BoostedTrees, Fit, boost
from orderloom.operators.metrics import add_errors, long_predictions
from orderloom.operators.scratch import materialize

SEED = 42
TREES = 200
# Quantile bins per feature. Split statistics travel as nodes x features x bins, so the
# bin count sets the shuffle volume of a fit.
MAX_BINS = 256
UNLIMITED_DEPTH = 30  # the deepest tree Spark ML grows

Fold = tuple[DataFrame, DataFrame]


class MeanRegressor(Estimator, HasLabelCol, HasPredictionCol):
    """Predicts the training mean."""

    @keyword_only
    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MeanModel":
        mean = dataset.agg(F.avg(self.getLabelCol())).first()[0]
        return MeanModel(mean, self.getPredictionCol())


class MeanModel(Model):
    def __init__(self, mean: float, column: str):
        super().__init__()
        self.mean = mean
        self.column = column

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.column, F.lit(self.mean))


@dataclass(frozen=True)
class Candidate:
    """A named estimator with its parameter grid."""

    name: str
    estimator: Estimator
    grid: list[dict]


def mean_baseline() -> Candidate:
    return Candidate("mean_baseline", MeanRegressor(), [{}])


def rf_candidates(trees: int = TREES, depths=(UNLIMITED_DEPTH, 12), leaves=(1, 3)) -> Candidate:
    forest = RandomForestRegressor(
        numTrees=trees, featureSubsetStrategy="all", maxBins=MAX_BINS, seed=SEED
    )
    grid = (
        ParamGridBuilder()
        .addGrid(forest.maxDepth, list(depths))
        .addGrid(forest.minInstancesPerNode, list(leaves))
        .build()
    )
    return Candidate("random_forest", forest, grid)


@dataclass(frozen=True)
class BoostedCandidate:
    """Boosted trees with their parameter grid; all of it is fitted at once."""

    name: str
    grid: list[dict]


def boosted_candidates(rates=(0.05, 0.1), iterations=(100, 200), leaves=(15, 31)) -> BoostedCandidate:
    grid = [
        {"learning_rate": rate, "max_iter": n, "max_leaf_nodes": most}
        for rate in rates for n in iterations for most in leaves
    ]
    return BoostedCandidate("hist_gradient_boosting", grid)


def _fold_bounds(months: Sequence, folds: int) -> list[tuple[int, int]]:
    """Positions of each fold's first validation month and of the month after its last."""
    if len(months) <= folds:
        raise ValueError("Development data must contain more months than folds.")
    size = len(months) // (folds + 1)
    return [(len(months) - n * size, len(months) - (n - 1) * size) for n in range(folds, 0, -1)]


def month_folds(df: DataFrame, folds: int = CV_FOLDS) -> list[Fold]:
    """Expanding windows over distinct months; all rows of a month stay on one side.

    Only the list of months reaches the driver.
    """
    months = [row["Month"] for row in df.select("Month").distinct().orderBy("Month").collect()]
    month = F.col("Month")
    return [
        (df.where(month < months[start]), df.where(month.between(months[start], months[stop - 1])))
        for start, stop in _fold_bounds(months, folds)
    ]


def fold_table(df: DataFrame, folds: int = CV_FOLDS) -> DataFrame:
    """Month ranges and row counts of every fold, from one count per month."""
    counted = df.groupBy("Month").count().orderBy("Month").collect()  # one row per month
    months, rows = [r["Month"] for r in counted], [r["count"] for r in counted]
    table = [
        (number, months[0], months[start - 1], sum(rows[:start]),
         months[start], months[stop - 1], sum(rows[start:stop]))
        for number, (start, stop) in enumerate(_fold_bounds(months, folds), start=1)
    ]
    return df.sparkSession.createDataFrame(
        table,
        "fold int, train_start date, train_end date, train_rows bigint, "
        "validation_start date, validation_end date, validation_rows bigint",
    )


@dataclass(frozen=True)
class Search:
    """Outcome of one candidate: its best parameters, score and refitted model."""

    name: str
    cv_mae: float
    params: dict[str, object]
    model: Model | BoostedTrees


def fold_scores(candidate: Candidate, folds: Sequence[Fold], parallelism: int = 4) -> list[tuple[int, int, float]]:
    """(grid index, fold number, MAE) of every grid point on every fold.

    Fits run as concurrent Spark jobs; each one is distributed by itself.
    """
    score = RegressionEvaluator(metricName="mae")

    def fold_mae(task: tuple[int, int]) -> tuple[int, int, float]:
        index, number = task
        train, valid = folds[number - 1]
        fitted = candidate.estimator.fit(train, candidate.grid[index])
        return index, number, score.evaluate(fitted.transform(valid))

    tasks = [(i, n) for i in range(len(candidate.grid)) for n in range(1, len(folds) + 1)]
    with ThreadPool(parallelism) as pool:
        return pool.map(fold_mae, tasks, chunksize=1)


def grid_search(
    candidate: Candidate, development: DataFrame, folds: Sequence[Fold], parallelism: int = 4
) -> Search:
    """Smallest unweighted mean of the folds' MAE, refitted on all development rows."""
    scores = fold_scores(candidate, folds, parallelism)
    means = {
        i: sum(mae for index, _, mae in scores if index == i) / len(folds)
        for i in range(len(candidate.grid))
    }
    best = min(means, key=means.get)
    chosen = candidate.grid[best]
    return Search(
        candidate.name,
        means[best],
        {param.name: value for param, value in chosen.items()},
        candidate.estimator.fit(development, chosen),
    )


def boosted_scores(candidate: BoostedCandidate, development: DataFrame, folds: int = CV_FOLDS):
    """(grid index, fold number, MAE) rows, and per grid point the model of all development rows.

    Grid points that differ in iterations alone are stages of one fit. The fits of all
    folds grow side by side, one in a task, or share every pass over more rows than that.
    """
    months = [row["Month"] for row in development.select("Month").distinct().orderBy("Month").collect()]
    bounds = [(months[start], months[stop - 1]) for start, stop in _fold_bounds(months, folds)]
    shapes = list(dict.fromkeys((g["learning_rate"], g["max_leaf_nodes"]) for g in candidate.grid))
    fits = [Fit(round(100 * rate), most, *bound) for rate, most in shapes for bound in (*bounds, (None, None))]
    stages = sorted({g["max_iter"] for g in candidate.grid})
    done = boost(development, fits, MODEL_FEATURES, stages[-1], stages, rows_per_task=boosting.ROWS_PER_TASK)
    scores, models = [], []
    for i, g in enumerate(candidate.grid):
        first = shapes.index((g["learning_rate"], g["max_leaf_nodes"])) * (folds + 1)
        scores += [(i, n + 1, done.errors[first + n, g["max_iter"]]) for n in range(folds)]
        models.append(done.models[first + folds].first(g["max_iter"]))
    return scores, models


def boosted_search(candidate: BoostedCandidate, development: DataFrame, folds: int = CV_FOLDS) -> Search:
    """`grid_search` of boosted trees; the refit is one of the fits."""
    scores, models = boosted_scores(candidate, development, folds)
    means = [sum(mae for index, _, mae in scores if index == i) / folds for i in range(len(candidate.grid))]
    best = means.index(min(means))
    return Search(candidate.name, means[best], candidate.grid[best], models[best])


ROWS_PER_TASK = (1_000, 1_000_000)  # least and most rows worth one training task


def _training_rows(development: DataFrame) -> DataFrame:
    """Stored, cached rows spread over the cores for the iterations of a fit.

    Adaptive execution may have packed a small panel into one partition, which would
    train on a single core. Hashing whole rows keeps the layout reproducible.
    """
    rows = materialize(development, "training-rows")
    least, most = ROWS_PER_TASK
    cores, count = rows.sparkSession.sparkContext.defaultParallelism, rows.count()
    parts = max(min(cores, count // least + 1), count // most)
    return rows.repartition(parts, *CELL_KEYS).persist()


def fit_selected(candidate: Candidate, development: DataFrame, index: int = 0) -> Model:
    """Fit one grid point on all development rows."""
    rows = _training_rows(development)
    try:
        return candidate.estimator.fit(rows, candidate.grid[index])
    finally:
        rows.unpersist()


def search_all(
    candidates: Sequence[Candidate | BoostedCandidate], development: DataFrame, folds: int = CV_FOLDS
) -> dict[str, Search]:
    """Search every candidate on the same cached folds of assembled development rows."""
    cached = _training_rows(development)
    try:
        splits = month_folds(cached, folds)
        return {
            c.name: boosted_search(c, cached, folds) if isinstance(c, BoostedCandidate) else grid_search(c, cached, splits)
            for c in candidates
        }
    finally:
        cached.unpersist()


def cv_results(df: DataFrame, searches: Mapping[str, Search]) -> DataFrame:
    """One row per model, best first."""
    rows = [(s.name, s.cv_mae, str(s.params)) for s in searches.values()]
    frame = df.sparkSession.createDataFrame(rows, "Model string, CV_MAE double, Best_Params string")
    return frame.orderBy("CV_MAE")


def selected_test_metrics(searches: Mapping[str, Search], test: DataFrame) -> DataFrame:
    """Test MAE and RMSE of the candidate with the best cross-validation score."""
    best = min(searches.values(), key=lambda s: s.cv_mae)
    error = F.col("prediction") - F.col("label")
    return best.model.transform(test).agg(
        F.lit(best.name).alias("Model"),
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
    )


def baseline_predictions(test: DataFrame) -> DataFrame:
    """Last month and the same month last year as forecasts."""
    return test.withColumns(
        {"Naive_Forecast": F.col("Demand_Lag_1"), "Seasonal_Naive_Forecast": F.col("Demand_Lag_12")}
    )


def predict_rf(model: Model, test: DataFrame) -> DataFrame:
    """Fixed-model predictions for assembled test rows."""
    return model.transform(test).withColumnRenamed("prediction", "Forecast_Demand")


def forecast_results(test: DataFrame, kind: str = "double") -> DataFrame:
    """The forecast fact from test rows that carry a `Forecast_Demand` column."""
    forecasts = list(MODEL_COLUMNS.values())
    baselines = [c for c in forecasts if c != "Forecast_Demand"]
    names = ("Forecast_Error", "Absolute_Error", "Squared_Error")
    wide = baseline_predictions(test).select(
        *CELL_KEYS, "Actual_Demand",
        *[F.col(c).cast(kind).alias(c) for c in (*sorted(baselines), "Forecast_Demand")],
    )
    return add_errors(wide, "Forecast_Demand", "Actual_Demand", names)


def benchmark_results(results: DataFrame, models: Mapping[str, str] = MODEL_COLUMNS) -> DataFrame:
    """MAE and RMSE per model on the same rows."""
    rows = long_predictions(results, models)
    errors = add_errors(rows, "forecast_demand", "Actual_Demand", ("error", "abs_error", "sq_error"))
    return (
        errors.groupBy("Model")
        .agg(
            ratio(F.sum("abs_error"), F.count("error")).alias("MAE"),
            F.sqrt(ratio(F.sum("sq_error"), F.count("error"))).alias("RMSE"),
        )
        .orderBy("MAE")
    )
