"""Row-level forecast errors and the summary block every accuracy report shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from orderloom.constants import EVALUATION_SCOPE, MODEL_COLUMNS
from orderloom.functions.numeric import pct, ratio


def add_errors(df: DataFrame, forecast: str, actual: str, names: Sequence[str]) -> DataFrame:
    """Forecast minus actual, its absolute value and its square."""
    error = F.col(forecast) - F.col(actual)
    return df.withColumns(dict(zip(names, (error, F.abs(error), error * error))))


def _common_type(kinds: Sequence[T.DataType]) -> str:
    """The narrowest decimal that holds every value of all columns if all are exact, else double."""
    whole = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
    exact = []
    for kind in kinds:
        if isinstance(kind, T.DecimalType):
            exact.append((kind.precision - kind.scale, kind.scale))
        elif type(kind) in whole:
            exact.append((whole[type(kind)], 0))
        else:
            return "double"
    digits, scale = max(d for d, _ in exact), max(s for _, s in exact)
    return f"decimal({digits + scale},{scale})" if digits + scale <= 38 else "double"


def long_predictions(
    results: DataFrame, models: Mapping[str, str] = MODEL_COLUMNS, carried: Sequence[str] = ()
) -> DataFrame:
    """One row per observation and model from the wide forecast fact."""
    shared = _common_type([results.schema[c].dataType for c in models.values()])
    labelled = results.select(
        F.col("Month").alias("forecast_month"), "Product_ID", "Region_ID", "Actual_Demand", *carried,
        *[F.col(c).cast(shared).alias(label) for label, c in models.items()],
    )
    keys = ["forecast_month", "Product_ID", "Region_ID", "Actual_Demand", *carried]
    return labelled.unpivot(keys, list(models), "Model", "forecast_demand")


def forecast_evaluation_detail(
    results: DataFrame,
    products: DataFrame,
    regions: DataFrame,
    models: Mapping[str, str] = MODEL_COLUMNS,
) -> DataFrame:
    """Long forecast fact with dimension names and errors at observation grain.

    Names are joined to the wide rows, before each becomes one row per model.
    """
    wide = results.join(products, "Product_ID").join(regions, "Region_ID")
    names = ("Product_Category", "Product_Line", "Region")
    named = long_predictions(wide, models, names).select(
        "forecast_month", "Product_ID", "Region_ID", "Actual_Demand", "Model", "forecast_demand",
        "Product_Category", "Product_Line", "Region",
        F.lit(EVALUATION_SCOPE).alias("evaluation_scope"),
    )
    errors = ("forecast_error", "absolute_error", "squared_error")
    return add_errors(named, "forecast_demand", "Actual_Demand", errors)


def error_summary(detail: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Metrics per group, with the additive parts that allow exact re-aggregation."""
    sums = detail.groupBy(*keys).agg(
        F.min("forecast_month").alias("evaluation_start"),
        F.max("forecast_month").alias("evaluation_end"),
        F.count(F.lit(1)).alias("observation_count"),
        F.count_distinct("forecast_month").alias("evaluated_months"),
        F.sum("Actual_Demand").alias("actual_demand"),
        F.sum("forecast_demand").alias("forecast_demand"),
        F.sum("absolute_error").alias("absolute_error_sum"),
        F.sum("squared_error").alias("squared_error_sum"),
        F.sum("forecast_error").alias("error_sum"),
        F.count_if(F.col("forecast_error") > 0).alias("overforecast_count"),
        F.count_if(F.col("forecast_error") < 0).alias("underforecast_count"),
    )
    measured = sums.withColumns(
        {
            "mae": ratio("absolute_error_sum", "observation_count"),
            "rmse": F.sqrt(ratio("squared_error_sum", "observation_count")),
            "wape_pct": pct("absolute_error_sum", "actual_demand"),
            "mean_bias": ratio("error_sum", "observation_count"),
            "forecast_bias_pct": pct("error_sum", "actual_demand"),
        }
    )
    counts = ["overforecast_count", "underforecast_count"]
    return measured.select(*[c for c in measured.columns if c not in counts], *counts)
