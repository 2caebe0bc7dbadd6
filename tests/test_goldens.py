"""Accuracy reports recomputed from a frozen forecast against published results.

Point ORDERLOOM_GOLDENS at a folder with `tables/` (products, regions), `forecast.csv`
and `reports/<report>.csv`; without it these tests are skipped.
"""

import csv
import os
from pathlib import Path

import pytest

from orderloom.operators.metrics import forecast_evaluation_detail
from orderloom.plans import error_review, forecast
from orderloom.sources.tables import read_forecast, read_table

FOLDER = os.environ.get("ORDERLOOM_GOLDENS", "")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no golden results given")

KEYS = {
    "model_benchmark": ["Model"],
    "annual_forecast_accuracy": ["forecast_year", "Model"],
    "product_forecast_accuracy": ["Product_ID", "Model"],
    "regional_forecast_accuracy": ["Region_ID", "Model"],
    "product_market_forecast_accuracy": ["Product_ID", "Region_ID", "Model"],
    "monthly_forecast_trend": ["forecast_month", "Model"],
    "series_benchmark_comparison": ["Product_ID", "Region_ID"],
    "repeated_forecast_bias": ["Product_ID", "Region_ID"],
}


@pytest.fixture(scope="module")
def results(spark):
    return read_forecast(spark, f"{FOLDER}/forecast.csv")


@pytest.fixture(scope="module")
def detail(spark, results):
    dims = [read_table(spark, n, f"{FOLDER}/tables/{n}.csv") for n in ("products", "regions")]
    return forecast_evaluation_detail(results, *dims).persist()


def report(name, detail):
    build = getattr(forecast, name)
    if name in ("series_benchmark_comparison", "repeated_forecast_bias"):
        return build(forecast.product_market_forecast_accuracy(detail))
    return build(detail)


@pytest.mark.parametrize("name", sorted(KEYS))
def test_report_equals_golden(detail, name):
    with open(Path(FOLDER) / "reports" / f"{name}.csv", encoding="utf-8-sig", newline="") as handle:
        golden = list(csv.DictReader(handle))
    frame = report(name, detail)
    assert set(frame.columns) == set(golden[0])
    ours = {tuple(str(r[k]) for k in KEYS[name]): r for r in frame.collect()}
    assert len(ours) == len(golden)
    for expected in golden:
        row = ours[tuple(expected[k] for k in KEYS[name])]
        for column, text in expected.items():
            value = row[column]
            if isinstance(value, bool) or not isinstance(value, (int, float)):
                assert ("" if value is None else str(value)) == text, (name, column)
            else:
                assert float(value) == pytest.approx(float(text), rel=1e-9, abs=1e-9), (name, column)


def test_row_counts_and_wins(results, detail):
    assert results.count() == 192 and detail.count() == 576
    assert forecast.planning_exceptions(detail).count() == 192
    summary = error_review.summarize_errors(results, ["Product_ID", "Region_ID"])
    overall = error_review.overall_summary(error_review.series_errors(summary), results).first()
    assert (overall["Series"], overall["Beats_Naive"], overall["Beats_Seasonal_Naive"], overall["Beats_Both"]) == (
        32, 28, 22, 19)
