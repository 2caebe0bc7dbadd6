"""Error analysis of the forecast fact: which segments and series miss, and how."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from orderloom.constants import (
    MODEL_COLUMNS, NAIVE, RANDOM_FOREST, REPEATED_BIAS_MIN, SEASONAL_NAIVE, SERIES_KEYS, TEST_MONTHS,
)
from orderloom.functions.numeric import pct, ratio
from orderloom.operators.metrics import add_errors, long_predictions


def summarize_errors(
    results: DataFrame, keys: Sequence[str], models: Mapping[str, str] = MODEL_COLUMNS
) -> DataFrame:
    """Error metrics of every model per segment, from one pass over the fact."""
    rows = long_predictions(results, models).withColumnRenamed("forecast_month", "Month")
    errors = add_errors(rows, "forecast_demand", "Actual_Demand", ("error", "abs_error", "sq_error"))
    sums = errors.groupBy(*keys, "Model").agg(
        F.count(F.lit(1)).alias("Observations"),
        F.sum("Actual_Demand").alias("Actual_Total"),
        F.sum("abs_error").alias("Absolute_Error_Total"),
        F.sum("sq_error").alias("_squares"),
        F.sum("error").alias("_errors"),
        F.count_if(F.col("error") > 0).alias("Overforecast_Count"),
        F.count_if(F.col("error") < 0).alias("Underforecast_Count"),
    )
    return sums.select(
        *keys, "Model", "Observations", "Actual_Total", "Absolute_Error_Total",
        ratio("Absolute_Error_Total", "Observations").alias("MAE"),
        F.sqrt(ratio("_squares", "Observations")).alias("RMSE"),
        pct("Absolute_Error_Total", "Actual_Total").alias("WAPE_pct"),
        ratio("_errors", "Observations").alias("Bias"),
        "Overforecast_Count", "Underforecast_Count",
    )


def series_errors(summary: DataFrame, primary_model: str = RANDOM_FOREST) -> DataFrame:
    """Primary-model errors per series with the baselines' MAE beside them.

    `summary` is `summarize_errors` by product and region. Shares are of the primary
    model's total absolute error.
    """
    compared = summary.groupBy(*SERIES_KEYS).pivot("Model", [NAIVE, SEASONAL_NAIVE]).agg(F.max("MAE"))
    primary = summary.where(F.col("Model") == primary_model)
    total = primary.agg(F.sum("Absolute_Error_Total")).scalar()
    beats = (F.col("MAE") < F.col(NAIVE)) & (F.col("MAE") < F.col(SEASONAL_NAIVE))
    return (
        primary.join(compared, SERIES_KEYS)
        .withColumn("Absolute_Error_Share_pct", pct("Absolute_Error_Total", total))
        .withColumn("Beats_Both_Baselines", beats)
    )


def top_series(series: DataFrame, n: int = 10) -> DataFrame:
    """The n series with the largest MAE."""
    return series.orderBy(F.desc("MAE"), *SERIES_KEYS).limit(n)


def repeated_bias(
    series: DataFrame, months: int = TEST_MONTHS, at_least: int = REPEATED_BIAS_MIN
) -> DataFrame:
    """Series erring in one direction nearly every month; every series must be complete."""
    if series.where(F.col("Observations") != months).limit(1).count():
        raise ValueError(f"Every series needs exactly {months} observations.")
    return series.where(
        (F.col("Overforecast_Count") >= at_least) | (F.col("Underforecast_Count") >= at_least)
    )


def not_beating(series: DataFrame) -> DataFrame:
    """Series where a baseline does at least as well."""
    return series.where(~F.col("Beats_Both_Baselines"))


def largest_errors(results: DataFrame, n: int = 5, forecast: str = "Forecast_Demand") -> DataFrame:
    """The n largest single errors."""
    names = ("Forecast_Error", "Absolute_Error", "Squared_Error")
    keys = ["Month", "Product_ID", "Region_ID"]
    return (
        add_errors(results, forecast, "Actual_Demand", names)
        .orderBy(F.desc("Absolute_Error"), *keys)
        .limit(n)
        .select(*keys, "Actual_Demand", forecast, "Forecast_Error")
    )


def overall_summary(series: DataFrame, results: DataFrame, forecast: str = "Forecast_Demand") -> DataFrame:
    """Wins against each baseline, overall WAPE and mean bias, in one row."""
    names = ("error", "abs_error", "sq_error")
    wins = series.agg(
        F.count(F.lit(1)).alias("Series"),
        F.count_if(F.col("MAE") < F.col(NAIVE)).alias("Beats_Naive"),
        F.count_if(F.col("MAE") < F.col(SEASONAL_NAIVE)).alias("Beats_Seasonal_Naive"),
        F.count_if("Beats_Both_Baselines").alias("Beats_Both"),
    )
    errors = add_errors(results, forecast, "Actual_Demand", names)
    wape = errors.agg(pct(F.sum("abs_error"), F.sum("Actual_Demand"))).scalar()
    bias = errors.agg(ratio(F.sum("error"), F.count("error"))).scalar()
    return wins.withColumns({"Overall_WAPE_pct": wape, "Overall_Mean_Bias": bias})
