"""Forecast accuracy and error-review reports over the long forecast detail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.constants import (
    DIRECTION_LABELS, NAIVE, RANDOM_FOREST, REPEATED_BIAS_MIN, REVIEW_REASONS, SEASONAL_NAIVE,
    TEST_MONTHS,
)
from orderloom.functions.numeric import pct
from orderloom.functions.ranking import ranks_and_sums
from orderloom.operators.metrics import error_summary


def forecast_detail(detail: DataFrame) -> DataFrame:
    return detail.orderBy("forecast_month", "Product_ID", "Region_ID", "Model")


def _accuracy(detail: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    return error_summary(detail, [*keys, "Model"]).orderBy(*order, "mae", "Model")


def model_benchmark(detail: DataFrame) -> DataFrame:
    return _accuracy(detail, [], [])


def annual_forecast_accuracy(detail: DataFrame) -> DataFrame:
    return _accuracy(detail, [F.year("forecast_month").alias("forecast_year")], ["forecast_year"])


def product_forecast_accuracy(detail: DataFrame) -> DataFrame:
    return _accuracy(detail, ["Product_ID", "Product_Category", "Product_Line"], ["Product_ID"])


def regional_forecast_accuracy(detail: DataFrame) -> DataFrame:
    return _accuracy(detail, ["Region_ID", "Region"], ["Region_ID"])


def product_market_forecast_accuracy(detail: DataFrame) -> DataFrame:
    keys = ["Product_ID", "Product_Category", "Product_Line", "Region_ID", "Region"]
    return _accuracy(detail, keys, ["Product_ID", "Region_ID"])


def monthly_forecast_trend(detail: DataFrame) -> DataFrame:
    return _accuracy(detail, ["forecast_month"], ["forecast_month"])


def series_benchmark_comparison(
    product_market: DataFrame, primary_model: str = RANDOM_FOREST
) -> DataFrame:
    """Primary model against both baselines, series by series, on MAE."""
    prefix = primary_model.lower().replace(" ", "_")
    primary = f"{prefix}_mae"

    def mae_of(model: str) -> Column:
        return F.max(F.when(F.col("Model") == model, F.col("mae")))

    scores = product_market.groupBy("Product_ID", "Product_Category", "Region_ID", "Region").agg(
        mae_of(primary_model).alias(primary),
        mae_of(NAIVE).alias("naive_mae"),
        mae_of(SEASONAL_NAIVE).alias("seasonal_naive_mae"),
    )
    own, naive, seasonal = F.col(primary), F.col("naive_mae"), F.col("seasonal_naive_mae")
    return scores.withColumns(
        {
            "beats_naive": own < naive,
            "beats_seasonal_naive": own < seasonal,
            "beats_both_baselines": own < F.least(naive, seasonal),
            "mae_reduction_vs_naive_pct": pct(naive - own, naive),
            "mae_reduction_vs_seasonal_pct": pct(seasonal - own, seasonal),
        }
    ).orderBy(F.desc_nulls_last(primary), "Product_ID", "Region_ID")


def repeated_forecast_bias(
    product_market: DataFrame, primary_model: str = RANDOM_FOREST
) -> DataFrame:
    """Series with a full set of test months and nearly all errors on one side."""
    over = F.col("overforecast_count") >= REPEATED_BIAS_MIN
    under = F.col("underforecast_count") >= REPEATED_BIAS_MIN
    full = F.col("observation_count") == TEST_MONTHS
    return (
        product_market.where((F.col("Model") == primary_model) & full & (over | under))
        .select(
            "Product_ID", "Product_Category", "Region_ID", "Region", "observation_count", "mae",
            "wape_pct", "mean_bias", "overforecast_count", "underforecast_count",
            F.when(over, REVIEW_REASONS["over"]).otherwise(REVIEW_REASONS["under"]).alias("review_reason"),
        )
        .orderBy(F.desc("mae"), "Product_ID", "Region_ID")
    )


def planning_exceptions(detail: DataFrame, primary_model: str = RANDOM_FOREST) -> DataFrame:
    """All primary-model rows ranked by absolute error, with no tolerance threshold."""
    error = F.col("forecast_error")
    direction = (
        F.when(error > 0, DIRECTION_LABELS["over"])
        .when(error < 0, DIRECTION_LABELS["under"])
        .otherwise(DIRECTION_LABELS["exact"])
    )
    rows = detail.where(F.col("Model") == primary_model).withColumns(
        {
            "forecast_error_pct": pct("forecast_error", "Actual_Demand"),
            "forecast_direction": direction,
        }
    )
    place = ["forecast_month", "Product_ID", "Region_ID"]
    ranked = ranks_and_sums(rows, "exception_priority", ["absolute_error"], [F.asc(c) for c in place])
    return ranked.orderBy("exception_priority", *place)
