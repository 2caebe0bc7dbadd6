from datetime import date
from decimal import Decimal

import pytest

from orderloom.operators import quality
from orderloom.operators.metrics import error_summary, forecast_evaluation_detail, long_predictions
from orderloom.plans import error_review, forecast
from tests.conftest import by_key

RESULT_TYPES = (
    "Month date, Product_ID string, Region_ID string, Actual_Demand bigint, Naive_Forecast double, "
    "Seasonal_Naive_Forecast double, Forecast_Demand double, Forecast_Error double, "
    "Absolute_Error double, Squared_Error double"
)


def fact(spark, rows):
    """Forecast fact from (month number, product, region, actual, naive, seasonal, forecast)."""
    full = [
        (date(2025, m, 1), p, r, a, float(n), float(s), float(f), float(f - a), float(abs(f - a)),
         float((f - a) ** 2))
        for m, p, r, a, n, s, f in rows
    ]
    return spark.createDataFrame(full, RESULT_TYPES)


@pytest.fixture(scope="module")
def results(spark):
    rows = []
    for month in range(7, 13):
        rows.append((month, "P1", "R1", 100, 110, 95, 102 if month < 12 else 99))  # 5 over, 1 under
        rows.append((month, "P2", "R1", 50, 50, 60, 40 if month % 2 else 60))  # 3 over, 3 under
        rows.append((month, "P3", "R2", 0, 0, 0, 0))  # zero demand, exact
    return fact(spark, rows)


@pytest.fixture(scope="module")
def detail(results, dims):
    return forecast_evaluation_detail(results, dims[1], dims[2])


def test_detail_has_three_rows_per_observation(results, detail):
    assert detail.count() == 3 * results.count()
    assert quality.check_row_ratio(detail, results).count() == 0
    assert quality.check_row_ratio(detail.where("Model <> 'Naive Forecast'"), results).count() == 1
    row = detail.where("Model = 'Naive Forecast' AND Product_ID = 'P1'").first()
    assert (row["forecast_error"], row["absolute_error"], row["squared_error"]) == (10.0, 10.0, 100.0)
    assert row["Region"] == "North" and row["evaluation_scope"].startswith("Final test")


def test_benchmark_metrics(detail):
    rows = by_key(forecast.model_benchmark(detail), "Model")
    forest = rows["Random Forest"]
    assert forest["observation_count"] == 18 and forest["evaluated_months"] == 6
    assert forest["mae"] == pytest.approx((5 * 2 + 1 + 60) / 18)
    assert forest["rmse"] == pytest.approx(((5 * 4 + 1 + 600) / 18) ** 0.5)
    assert forest["wape_pct"] == pytest.approx(100 * 71 / 900)
    assert forest["overforecast_count"] == 8 and forest["underforecast_count"] == 4
    assert [r["Model"] for r in forecast.model_benchmark(detail).collect()] == [
        "Naive Forecast", "Random Forest", "Seasonal Naive"]  # smallest MAE first


def test_zero_demand_has_no_percentage(detail):
    rows = by_key(forecast.product_forecast_accuracy(detail), "Product_ID", "Model")
    assert rows[("P3", "Random Forest")]["wape_pct"] is None
    assert rows[("P3", "Random Forest")]["forecast_bias_pct"] is None
    assert rows[("P3", "Random Forest")]["mae"] == 0.0


def test_finer_views_add_up_to_the_benchmark(detail):
    views = {
        "annual": forecast.annual_forecast_accuracy(detail),
        "series": forecast.product_market_forecast_accuracy(detail),
        "month": forecast.monthly_forecast_trend(detail),
        "region": forecast.regional_forecast_accuracy(detail),
    }
    benchmark = forecast.model_benchmark(detail)
    assert quality.check_grouped_totals(views, benchmark).count() == 0
    partial = {"month": views["month"].where("forecast_month > date'2025-07-01'")}
    assert quality.check_grouped_totals(partial, benchmark).count() == 3


def test_metrics_gate(results, detail):
    benchmark = forecast.model_benchmark(detail)
    assert quality.check_metrics(benchmark, results).count() == 0
    assert quality.check_metrics(benchmark.withColumn("mae", benchmark["mae"] + 1), results).count() == 3
    assert quality.check_metrics(benchmark.where("Model <> 'Naive Forecast'"), results).count() == 1


def test_series_comparison_is_strict(detail):
    markets = forecast.product_market_forecast_accuracy(detail)
    rows = by_key(forecast.series_benchmark_comparison(markets), "Product_ID")
    assert rows["P1"]["beats_both_baselines"] is True
    assert rows["P2"]["beats_naive"] is False and rows["P2"]["beats_seasonal_naive"] is False
    assert rows["P3"]["beats_both_baselines"] is False and rows["P3"]["mae_reduction_vs_naive_pct"] is None
    assert rows["P1"]["mae_reduction_vs_naive_pct"] == pytest.approx(100 * (10 - 11 / 6) / 10)


def test_repeated_bias_needs_five_of_exactly_six(detail, dims, spark):
    markets = forecast.product_market_forecast_accuracy(detail)
    flagged = forecast.repeated_forecast_bias(markets).collect()
    assert [(r["Product_ID"], r["review_reason"][:4]) for r in flagged] == [("P1", "Over")]
    five = fact(spark, [(m, "P1", "R1", 10, 10, 10, 11) for m in range(7, 12)])
    short = forecast_evaluation_detail(five, dims[1], dims[2])
    assert forecast.repeated_forecast_bias(forecast.product_market_forecast_accuracy(short)).count() == 0


def test_planning_exceptions_rank_all_rows(detail):
    rows = forecast.planning_exceptions(detail).collect()
    assert len(rows) == 18
    assert {(r["Product_ID"], r["exception_priority"]) for r in rows} == {
        ("P2", 1), ("P1", 2), ("P1", 3), ("P3", 4)}
    assert {r["forecast_direction"] for r in rows} == {"Overforecast", "Underforecast", "Exact"}
    assert all(r["forecast_error_pct"] is None for r in rows if r["Product_ID"] == "P3")


def test_error_review(results):
    summary = error_review.summarize_errors(results, ["Product_ID", "Region_ID"])
    series = error_review.series_errors(summary)
    rows = by_key(series, "Product_ID")
    assert rows["P2"]["Absolute_Error_Share_pct"] == pytest.approx(100 * 60 / 71)
    assert rows["P1"]["Beats_Both_Baselines"] is True
    assert [r["Product_ID"] for r in error_review.top_series(series, 2).collect()] == ["P2", "P1"]
    assert [r["Product_ID"] for r in error_review.repeated_bias(series).collect()] == ["P1"]
    assert {r["Product_ID"] for r in error_review.not_beating(series).collect()} == {"P2", "P3"}
    largest = error_review.largest_errors(results, 2).collect()
    assert [abs(r["Forecast_Error"]) for r in largest] == [10.0, 10.0]
    overall = error_review.overall_summary(series, results).first()
    assert (overall["Series"], overall["Beats_Naive"], overall["Beats_Seasonal_Naive"]) == (3, 1, 1)
    assert overall["Overall_WAPE_pct"] == pytest.approx(100 * 71 / 900)
    with pytest.raises(ValueError):
        error_review.repeated_bias(series, months=7)


def test_summary_of_nothing_is_empty(detail):
    assert error_summary(detail.limit(0), ["Model"]).count() == 0


def test_decimal_forecasts_keep_their_scale(spark):
    kinds = "Month date, Product_ID string, Region_ID string, Actual_Demand bigint, a decimal(10,4), b decimal(12,2)"
    rows = spark.createDataFrame([(date(2024, 1, 1), "P", "R", 4, Decimal("4.1234"), Decimal("5.25"))], kinds)
    found = {r["Model"]: r["forecast_demand"] for r in long_predictions(rows, {"A": "a", "B": "b"}).collect()}
    assert found == {"A": Decimal("4.1234"), "B": Decimal("5.2500")}
