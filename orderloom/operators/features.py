"""Leakage-free history features and the chronological test split.

Each window holds one product-region series, whose length is the number of months.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from orderloom.constants import (
    HISTORY_COLUMNS, LAGS, MODEL_FEATURES, ROLLING_WINDOWS, SERIES_KEYS, TEST_MONTHS,
)
from orderloom.operators.panel import calendar_features, complete_panel, monthly_observed
from orderloom.operators.scratch import materialize


def _series() -> WindowSpec:
    return Window.partitionBy(*SERIES_KEYS).orderBy("Month")


def add_lags(panel: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Demand of earlier months of the same series."""
    return panel.withColumns(
        {f"Demand_Lag_{n}": F.lag("Actual_Demand", n).over(_series()) for n in lags}
    )


def add_rolling(panel: DataFrame, windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """Mean demand of the preceding months, the current one excluded; NULL until full."""

    def trailing_mean(size: int):
        before = _series().rowsBetween(-size, -1)
        known = F.count("Actual_Demand").over(before)
        total = F.sum("Actual_Demand").over(before).cast("double")
        return F.when(known == size, total / size)

    return panel.withColumns({f"Demand_Rolling_Mean_{n}": trailing_mean(n) for n in windows})


def demand_features(panel: DataFrame) -> DataFrame:
    """The panel with all history features; one sort per series serves every window."""
    return add_rolling(add_lags(panel))


def drop_warmup(features: DataFrame, columns: Sequence[str] = HISTORY_COLUMNS) -> DataFrame:
    """Rows whose whole history is known."""
    return features.dropna(subset=list(columns))


def split_final(
    usable: DataFrame, months: int = TEST_MONTHS, last_month: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Development rows and the untouched last months.

    A known last month spares a pass over the features.
    """
    last = usable.agg(F.max("Month")).scalar() if last_month is None else last_month
    start = F.add_months(last, -(months - 1))
    return usable.where(F.col("Month") < start), usable.where(F.col("Month") >= start)


def assemble(df: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Feature vector and label; series ids are deliberately not features."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)
    return vectors.withColumn("label", F.col("Actual_Demand").cast("double"))


@dataclass(frozen=True)
class DemandHistory:
    """Panel, features and the chronological split of one order fact."""

    observed: DataFrame
    panel: DataFrame
    features: DataFrame
    usable: DataFrame
    development: DataFrame
    test: DataFrame


def demand_history(
    orders: DataFrame, months: int = TEST_MONTHS, store_features: bool = False
) -> DemandHistory:
    """From orders to test rows with one scan of the fact.

    The observed month cells are stored and give the year and month bounds. Store the
    features as well when both sides of the split are read, possibly several times.
    """
    observed = materialize(monthly_observed(orders), "monthly-observed")
    first_year = observed.agg(F.year(F.min("Month"))).scalar()
    panel = calendar_features(complete_panel(observed), first_year)
    features = demand_features(panel)
    if store_features:
        features = materialize(features, "demand-features")
    usable = drop_warmup(features)
    last_month = observed.agg(F.max("Month")).scalar()
    return DemandHistory(observed, panel, features, usable, *split_final(usable, months, last_month))
