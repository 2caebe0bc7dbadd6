"""The report registry and the two end-to-end runs built on it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from orderloom.constants import MODEL_COLUMNS, RANDOM_FOREST
from orderloom.operators import modeling, quality
from orderloom.operators.features import DemandHistory, assemble, demand_history
from orderloom.operators.metrics import forecast_evaluation_detail
from orderloom.operators.scratch import materialize
from orderloom.plans import customers, forecast, fulfillment, sales
from orderloom.sources.sinks import export_reports, report_names


@dataclass(frozen=True)
class Tables:
    """The five inputs of the reports."""

    orders: DataFrame
    customers: DataFrame
    products: DataFrame
    regions: DataFrame
    results: DataFrame


def prepared(tables: Tables) -> Tables:
    """The tables with the order fact reduced once, and stored, for all reports to read.

    The joins behind the fact are then made once and not for each of the twelve reports
    that read it, and lines of an order that agree in everything reported are one row.
    """
    orders = materialize(fulfillment.fold_lines(tables.orders), "order-lines")
    return replace(tables, orders=orders, results=materialize(tables.results, "forecast-fact"))


def reports(
    tables: Tables,
    models: Mapping[str, str] = MODEL_COLUMNS,
    primary_model: str = RANDOM_FOREST,
) -> dict[str, Callable[[], DataFrame]]:
    """All 21 reports by export name; each is built only when called."""
    t = tables
    detail = forecast_evaluation_detail(t.results, t.products, t.regions, models)

    def markets() -> DataFrame:
        return forecast.product_market_forecast_accuracy(detail)

    registry: dict[str, Callable[[], DataFrame]] = {
        "annual_sales_trend": lambda: sales.annual_sales_trend(t.orders),
        "regional_sales_contribution": lambda: sales.regional_sales_contribution(t.orders, t.regions),
        "product_revenue_contribution": lambda: sales.product_revenue_contribution(t.orders, t.products),
        "customer_value_ranking": lambda: customers.customer_value_ranking(
            t.orders, t.customers, t.regions
        ),
        "customer_type_performance": lambda: customers.customer_type_performance(t.orders, t.customers),
        "customer_growth_and_risk": lambda: customers.customer_growth_and_risk(
            t.orders, t.customers, t.regions
        ),
        "regional_market_opportunity": lambda: customers.regional_market_opportunity(
            t.orders, t.customers, t.regions
        ),
        "forecast_detail": lambda: forecast.forecast_detail(detail),
        "model_benchmark": lambda: forecast.model_benchmark(detail),
        "annual_forecast_accuracy": lambda: forecast.annual_forecast_accuracy(detail),
        "product_forecast_accuracy": lambda: forecast.product_forecast_accuracy(detail),
        "regional_forecast_accuracy": lambda: forecast.regional_forecast_accuracy(detail),
        "product_market_forecast_accuracy": markets,
        "monthly_forecast_trend": lambda: forecast.monthly_forecast_trend(detail),
        "series_benchmark_comparison": lambda: forecast.series_benchmark_comparison(
            markets(), primary_model
        ),
        "repeated_forecast_bias": lambda: forecast.repeated_forecast_bias(markets(), primary_model),
        "planning_exceptions": lambda: forecast.planning_exceptions(detail, primary_model),
        "annual_fulfillment_kpi": lambda: fulfillment.annual_fulfillment_kpi(t.orders),
        "regional_fulfillment_performance": lambda: fulfillment.regional_fulfillment_performance(
            t.orders, t.regions
        ),
        "product_fulfillment_bottlenecks": lambda: fulfillment.product_fulfillment_bottlenecks(
            t.orders, t.products
        ),
        "monthly_demand_fulfillment_reconciliation": (
            lambda: fulfillment.monthly_demand_fulfillment_reconciliation(t.orders, detail, primary_model)
        ),
    }
    report_names(registry)
    return registry


GROUPED_VIEWS = (
    "annual_forecast_accuracy", "product_forecast_accuracy", "regional_forecast_accuracy",
    "product_market_forecast_accuracy", "monthly_forecast_trend",
)


def run_reports(
    tables: Tables,
    folder: str,
    file_format: str = "csv",
    models: Mapping[str, str] = MODEL_COLUMNS,
    primary_model: str = RANDOM_FOREST,
) -> dict[str, int]:
    """Gate the inputs, build, gate the results, and only then write every report."""
    quality.enforce(
        quality.input_gate(
            tables.orders, tables.customers, tables.products, tables.regions, tables.results
        )
    )
    tables = prepared(tables)
    built = {name: build() for name, build in reports(tables, models, primary_model).items()}
    # The one gated report that reads the orders: computed once for gate and export.
    name = "monthly_demand_fulfillment_reconciliation"
    built[name] = materialize(built[name], name).orderBy("forecast_month")
    detail = forecast_evaluation_detail(tables.results, tables.products, tables.regions, models)
    quality.enforce(
        quality.result_gate(
            tables.results, detail, built["model_benchmark"],
            {view: built[view] for view in GROUPED_VIEWS},
            built[name], models,
        )
    )
    return export_reports(built, folder, file_format)


@dataclass(frozen=True)
class ForecastRun:
    history: DemandHistory
    searches: dict[str, modeling.Search]
    results: DataFrame
    selected_metrics: DataFrame


REQUIRED_ORDER_COLUMNS = ("Order_ID", "Order_Date", "Product_ID", "Region_ID", "Quantity")


def run_forecast(
    orders: DataFrame, candidates: list[modeling.Candidate | modeling.BoostedCandidate] | None = None
) -> ForecastRun:
    """Orders to the forecast fact: gates, panel, features, chronological search, test forecast.

    The forest makes the forecast even when another candidate has the better score.
    """
    quality.check_columns(orders, REQUIRED_ORDER_COLUMNS)
    report = quality.quality_report(orders, REQUIRED_ORDER_COLUMNS)
    quality.enforce({"order quality": quality.check_quality_report(report)})
    steps = demand_history(orders, store_features=True)
    quality.enforce(
        {
            "panel": quality.check_panel(steps.panel),
            "split": quality.check_split(steps.development, steps.test),
            "panel demand": quality.panel_reconciliation(steps.panel, steps.observed),
        }
    )
    chosen = candidates or [
        modeling.mean_baseline(), modeling.rf_candidates(), modeling.boosted_candidates()
    ]
    searches = modeling.search_all(chosen, assemble(steps.development))
    test = assemble(steps.test)
    predicted = modeling.predict_rf(searches["random_forest"].model, test)
    results = materialize(modeling.forecast_results(predicted), "forecast-fact")
    quality.enforce(quality.forecast_gate(results, steps.observed, steps.test))
    return ForecastRun(steps, searches, results, modeling.selected_test_metrics(searches, test))
