"""Every registered query: a callable from (spark, scale directory) to a DataFrame.

The order star is derived from the driver's tables. Tree models cannot be written in
SQL, so the forecast whose reports are compared with SQL is a six-month moving average
under its own label; forest queries are registered beside it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from orderloom.constants import CELL_KEYS as MODEL_CELL, MODEL_COLUMNS, MODEL_FEATURES, NAIVE, SEASONAL_NAIVE
from orderloom.operators import boosting, modeling, quality
from orderloom.operators.features import DemandHistory, assemble, demand_history
from orderloom.operators.metrics import forecast_evaluation_detail
from orderloom.operators.panel import ORDER_COLUMNS as PANEL_COLUMNS, month_spine, monthly_observed
from orderloom.operators.scratch import materialize, scratch_path
from orderloom.plans import (
    customers, datasets, diagnostics, error_review, forecast, fulfillment, measures, sales,
)
from orderloom.plans.reports import Tables, prepared, reports
from orderloom.session import configure
from orderloom.sources.sinks import export_reports, write_forecast, write_frame, write_panel
from orderloom.sources.star import Star
from orderloom.sources.tables import (
    parse_dates, parse_numbers, read_forecast, read_table, read_text_table, register_sources,
)

PRIMARY = "Moving Average 6"
MODELS = {
    PRIMARY: "Forecast_Demand",
    NAIVE: MODEL_COLUMNS[NAIVE],
    SEASONAL_NAIVE: MODEL_COLUMNS[SEASONAL_NAIVE],
}
DECIMAL = "decimal(18,2)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Plain result types: whole numbers as bigint, decimals as double."""
    plain = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            plain[f.name] = F.col(f"`{f.name}`").cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            plain[f.name] = F.col(f"`{f.name}`").cast("bigint")
    return df.withColumns(plain) if plain else df


def register(build: Callable[[Star], DataFrame], name: str | None = None) -> Callable[[Star], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Star(configure(spark), sf_dir)))

    QUERIES[name or build.__name__] = run
    return build


# --- shared steps ----------------------------------------------------------------


def history(star: Star) -> DemandHistory:
    return demand_history(star.orders(*PANEL_COLUMNS))


def forecast_rows(star: Star) -> DataFrame:
    """The forecast fact, for queries that read it once."""
    test = history(star).test.withColumn("Forecast_Demand", F.col("Demand_Rolling_Mean_6").cast(DECIMAL))
    return modeling.forecast_results(test, DECIMAL)


def results(star: Star) -> DataFrame:
    """The frozen forecast fact, stored for queries that read it several times."""
    return materialize(forecast_rows(star), "forecast-fact")


def detail(star: Star, stored: bool = False) -> DataFrame:
    fact = results(star) if stored else forecast_rows(star)
    return forecast_evaluation_detail(fact, star.products(), star.regions(), MODELS)


# --- sales, customers, delivery ----------------------------------------------------


@register
def annual_sales_trend(star: Star) -> DataFrame:
    return sales.annual_sales_trend(star.orders(*sales.ANNUAL_COLUMNS))


@register
def regional_sales_contribution(star: Star) -> DataFrame:
    return sales.regional_sales_contribution(star.orders(*sales.REGIONAL_COLUMNS), star.regions())


@register
def product_revenue_contribution(star: Star) -> DataFrame:
    return sales.product_revenue_contribution(star.orders(*sales.PRODUCT_COLUMNS), star.products())


@register
def customer_value_ranking(star: Star) -> DataFrame:
    orders = star.orders(*customers.VALUE_COLUMNS)
    return customers.customer_value_ranking(orders, star.customers(), star.regions())


@register
def customer_type_performance(star: Star) -> DataFrame:
    return customers.customer_type_performance(star.orders(*customers.TYPE_COLUMNS), star.customers())


@register
def customer_growth_and_risk(star: Star) -> DataFrame:
    orders = star.orders(*customers.YEARLY_COLUMNS)
    return customers.customer_growth_and_risk(orders, star.customers(), star.regions())


@register
def regional_market_opportunity(star: Star) -> DataFrame:
    orders = star.orders(*customers.YEARLY_COLUMNS)
    return customers.regional_market_opportunity(orders, star.customers(), star.regions())


@register
def annual_fulfillment_kpi(star: Star) -> DataFrame:
    return fulfillment.annual_fulfillment_kpi(star.orders(*fulfillment.ANNUAL_COLUMNS))


@register
def regional_fulfillment_performance(star: Star) -> DataFrame:
    orders = star.orders(*fulfillment.REGIONAL_COLUMNS)
    return fulfillment.regional_fulfillment_performance(orders, star.regions())


@register
def product_fulfillment_bottlenecks(star: Star) -> DataFrame:
    orders = star.orders(*fulfillment.PRODUCT_COLUMNS)
    return fulfillment.product_fulfillment_bottlenecks(orders, star.products())


@register
def monthly_demand_fulfillment_reconciliation(star: Star) -> DataFrame:
    orders = star.orders(*fulfillment.RECONCILIATION_COLUMNS, "Order_Time")
    return fulfillment.monthly_demand_fulfillment_reconciliation(
        orders, detail(star, stored=True), PRIMARY
    )


# --- panel, features, split --------------------------------------------------------


@register
def monthly_observed_demand(star: Star) -> DataFrame:
    return monthly_observed(star.orders(*PANEL_COLUMNS))


@register
def monthly_spine(star: Star) -> DataFrame:
    return month_spine(monthly_observed(star.orders(*PANEL_COLUMNS)))


for _step in ("panel", "features", "usable", "development", "test"):
    register(lambda star, step=_step: getattr(history(star), step), f"demand_{_step}")


@register
def month_folds(star: Star) -> DataFrame:
    return modeling.fold_table(history(star).development)


# --- forecast accuracy ---------------------------------------------------------------

register(forecast_rows, "forecast_results")


@register
def benchmark_results(star: Star) -> DataFrame:
    return modeling.benchmark_results(forecast_rows(star), MODELS)


for _report in (
    forecast.forecast_detail, forecast.model_benchmark, forecast.annual_forecast_accuracy,
    forecast.product_forecast_accuracy, forecast.regional_forecast_accuracy,
    forecast.product_market_forecast_accuracy, forecast.monthly_forecast_trend,
):
    register(lambda star, report=_report: report(detail(star)), _report.__name__)


@register
def series_benchmark_comparison(star: Star) -> DataFrame:
    markets = forecast.product_market_forecast_accuracy(detail(star))
    return forecast.series_benchmark_comparison(markets, PRIMARY)


@register
def repeated_forecast_bias(star: Star) -> DataFrame:
    markets = forecast.product_market_forecast_accuracy(detail(star))
    return forecast.repeated_forecast_bias(markets, PRIMARY)


@register
def planning_exceptions(star: Star) -> DataFrame:
    return forecast.planning_exceptions(detail(star), PRIMARY)


# --- error review --------------------------------------------------------------------

for _label, _keys in {
    "product": ["Product_ID"], "region": ["Region_ID"], "month": ["Month"],
    "series": ["Product_ID", "Region_ID"],
}.items():
    register(
        lambda star, keys=_keys: error_review.summarize_errors(forecast_rows(star), keys, MODELS),
        f"errors_by_{_label}",
    )


def reviewed_series(star: Star) -> DataFrame:
    summary = error_review.summarize_errors(forecast_rows(star), ["Product_ID", "Region_ID"], MODELS)
    return error_review.series_errors(materialize(summary, "series-errors"), PRIMARY)


register(reviewed_series, "series_errors")
register(lambda star: error_review.top_series(reviewed_series(star)), "top_series")
register(lambda star: error_review.repeated_bias(reviewed_series(star)), "repeated_bias_series")
register(lambda star: error_review.not_beating(reviewed_series(star)), "not_beating_baselines")
register(lambda star: error_review.largest_errors(forecast_rows(star)), "largest_errors")


@register
def overall_summary(star: Star) -> DataFrame:
    fact = results(star)
    summary = error_review.summarize_errors(fact, ["Product_ID", "Region_ID"], MODELS)
    return error_review.overall_summary(error_review.series_errors(summary, PRIMARY), fact)


# --- order diagnostics -----------------------------------------------------------------

FOCUS_PRODUCTS, FOCUS_REGION = ["Brand#3", "Brand#4"], 3
CHANGE_MONTHS = ("2001-06-01", "2001-07-01")
TEST_START = "2001-03-01"


def order_rows(star: Star) -> DataFrame:
    return diagnostics.focus(star.orders(*diagnostics.ORDER_COLUMNS, "Order_Time"))


@register
def focus_orders(star: Star) -> DataFrame:
    return diagnostics.focus(star.orders(*diagnostics.ORDER_COLUMNS), FOCUS_PRODUCTS, FOCUS_REGION)


register(lambda star: diagnostics.order_diagnostics(order_rows(star)), "order_diagnostics")
register(lambda star: diagnostics.customer_concentration(order_rows(star)), "customer_concentration")
register(lambda star: diagnostics.customer_monthly(order_rows(star)), "customer_monthly")
register(lambda star: diagnostics.customer_change(order_rows(star), *CHANGE_MONTHS), "customer_change")
register(lambda star: diagnostics.largest_orders(order_rows(star)), "largest_orders")
register(lambda star: diagnostics.status_matrix(order_rows(star)), "status_matrix")
register(lambda star: diagnostics.size_quantiles(order_rows(star), TEST_START), "size_quantiles")


@register
def demand_decomposition(star: Star) -> DataFrame:
    return diagnostics.demand_decomposition(diagnostics.order_diagnostics(order_rows(star)))


@register
def weighted_price(star: Star) -> DataFrame:
    return diagnostics.weighted_price(diagnostics.order_diagnostics(order_rows(star)))


@register
def focus_test(star: Star) -> DataFrame:
    return diagnostics.focus_test(demand_decomposition(star), results(star))


@register
def decomposition_violations(star: Star) -> DataFrame:
    return diagnostics.change_violations(demand_decomposition(star)).select(
        "Month", "Product_ID", "Region_ID"
    )


# --- quality gates ---------------------------------------------------------------------


@register
def quality_report(star: Star) -> DataFrame:
    required = ["Order_ID", "Order_Date", "Product_ID", "Region_ID", "Quantity"]
    return quality.quality_report(star.orders(*required), required)


@register
def duplicate_line_keys(star: Star) -> DataFrame:
    return quality.check_key(star.table("lineitem"), "l_orderkey", "l_linenumber")


@register
def duplicate_order_keys(star: Star) -> DataFrame:
    return quality.check_key(star.table("orders"), "o_orderkey")


@register
def order_rule_violations(star: Star) -> DataFrame:
    columns = ("Order_Date", "Quantity", "Revenue", "Delivery_Days", "Order_Status")
    return quality.count_broken_rules(star.orders(*columns), quality.order_rules())


@register
def reference_violations(star: Star) -> DataFrame:
    buyers, areas = star.customers(), star.regions()
    return quality.count_violations(
        {
            "order products": quality.check_reference(
                star.orders("Product_ID"), star.products(), "Product_ID"
            ),
            "order regions": quality.check_reference(star.orders("Region_ID"), areas, "Region_ID"),
            "order customers": quality.check_reference(star.orders("Customer_ID"), buyers, "Customer_ID"),
            "customer regions": quality.check_reference(buyers, areas, "Region_ID"),
        }
    )


@register
def customers_without_orders(star: Star) -> DataFrame:
    return quality.check_reference(star.customers(), star.orders("Customer_ID"), "Customer_ID")


register(lambda star: quality.panel_report(materialize(history(star).panel, "panel")), "panel_report")


@register
def split_report(star: Star) -> DataFrame:
    steps = history(star)
    return quality.split_report(steps.development, steps.test)


@register
def baseline_mismatches(star: Star) -> DataFrame:
    fact = results(star)
    cells = materialize(monthly_observed(star.orders(*PANEL_COLUMNS)), "monthly-observed")
    return quality.count_violations(
        {
            "forecast actuals": quality.check_actuals(fact, cells),
            "naive baseline": quality.check_baseline(fact, cells, "Naive_Forecast", 1),
            "seasonal baseline": quality.check_baseline(fact, cells, "Seasonal_Naive_Forecast", 12),
        }
    )


register(
    lambda star: quality.count_broken_rules(forecast_rows(star), quality.forecast_rules()),
    "forecast_rule_violations",
)


def accuracy_views(rows: DataFrame) -> dict[str, DataFrame]:
    return {
        "annual": forecast.annual_forecast_accuracy(rows),
        "product": forecast.product_forecast_accuracy(rows),
        "region": forecast.regional_forecast_accuracy(rows),
        "series": forecast.product_market_forecast_accuracy(rows),
        "month": forecast.monthly_forecast_trend(rows),
    }


register(lambda star: quality.grouped_totals(accuracy_views(detail(star, stored=True))), "grouped_totals")


register(lambda star: quality.recomputed_metrics(forecast_rows(star), MODELS), "recomputed_metrics")


@register
def result_gate(star: Star) -> DataFrame:
    fact = results(star)
    rows = forecast_evaluation_detail(fact, star.products(), star.regions(), MODELS)
    orders = star.orders(*fulfillment.RECONCILIATION_COLUMNS, "Order_Time")
    reconciled = fulfillment.monthly_demand_fulfillment_reconciliation(orders, rows, PRIMARY)
    benchmark = forecast.model_benchmark(rows)
    return quality.result_gate(fact, rows, benchmark, accuracy_views(rows), reconciled, MODELS)


# Faults planted in the given tables, to show that the gates find each kind. Which rows
# get one depends on their keys alone.


def planted_orders(star: Star) -> DataFrame:
    def planted(kind: int, column: str, value) -> Column:
        return F.when(F.col("Order_ID") % 97 == kind, value).otherwise(F.col(column))

    none = F.lit(None)
    return star.orders().withColumns({
        "Quantity": planted(0, "Quantity", F.lit(0)), "Product_ID": planted(1, "Product_ID", F.lit("none")),
        "Region_ID": planted(2, "Region_ID", F.lit(99)), "Customer_ID": planted(3, "Customer_ID", F.lit(-1)),
        "Order_Status": planted(4, "Order_Status", F.lit("Lost")), "Order_Date": planted(5, "Order_Date", none),
        "Delivery_Days": planted(6, "Delivery_Days", none),
    })


def planted_results(star: Star) -> DataFrame:
    """Every fault in one product's rows, one region after the other."""
    def at(product: str, region: int) -> Column:
        return (F.col("Product_ID") == f"Brand#{product}") & (F.col("Region_ID") == region)

    def planted(where: Column, column: str, value: Column) -> Column:
        return F.when(where, value).otherwise(F.col(column))

    fact = forecast_rows(star)
    changed = fact.withColumns({
        "Actual_Demand": planted(at("2", 0), "Actual_Demand", F.lit(-5)),
        "Naive_Forecast": planted(at("2", 1), "Naive_Forecast", F.col("Naive_Forecast") + 1),
        "Seasonal_Naive_Forecast": planted(at("2", 2), "Seasonal_Naive_Forecast", F.lit(None)),
        "Squared_Error": planted(at("2", 3), "Squared_Error", F.col("Squared_Error") + 2),
        "Month": planted(at("2", 4), "Month", F.date_add("Month", 1)),
    })
    lost = changed.where(at("3", 0)).withColumn("Product_ID", F.lit("none"))
    moved = changed.where(at("3", 1)).withColumn("Region_ID", F.lit(99))
    return changed.unionByName(lost).unionByName(moved).unionByName(changed.where(at("3", 2)))


@register
def planted_input_gate(star: Star) -> DataFrame:
    """What the input gate counts on tables with planted faults."""
    buyers, items, areas = star.customers(), star.products(), star.regions()
    stray = F.when(F.col("Customer_ID") % 50 == 0, 99).otherwise(F.col("Region_ID"))
    return quality.input_gate(
        planted_orders(star),
        buyers.withColumn("Region_ID", stray).unionByName(buyers.where(F.col("Customer_ID") % 40 == 0)),
        items.unionByName(items.where("Product_ID = 'Brand#4'")),
        areas.unionByName(areas.where("Region_ID < 2")),
        materialize(planted_results(star), "planted-forecast"),
    )


@register
def panel_reconciliation(star: Star) -> DataFrame:
    """Cells in which a panel with planted faults and the orders differ, from both sides."""
    steps = history(star)
    at = F.concat_ws("/", "Product_ID", "Region_ID", F.month("Month"))
    changed = steps.panel.where(at != "Brand#2/1/5").withColumn(
        "Actual_Demand", F.col("Actual_Demand") + F.when(at == "Brand#6/2/7", 3).otherwise(0)
    )
    twice = changed.where(at == "Brand#9/0/2")
    late = steps.observed.where(at == "Brand#1/4/3").withColumn("Month", F.add_months("Month", 600))
    return quality.panel_reconciliation(changed.unionByName(twice), steps.observed.unionByName(late))


# --- measures --------------------------------------------------------------------------

# Slicer selections used by the filtered measure queries.
CHOSEN = {
    "Region": ["ASIA", "EUROPE"],
    "Customer_Type": ["BUILDING", "MACHINERY"],
    "Product_Category": ["Category 1", "Category 2", "Category 3"],
    "Year": [1999, 2000],
}


def model(star: Star, with_forecast: bool = False) -> measures.SalesModel:
    fact = forecast_rows(star) if with_forecast else None
    # Stored, because the brands are derived: a scan of them has a known, small size, and
    # the join with the order fact is then planned by that size and not by the part table's.
    products = materialize(star.products(), "products")
    return measures.SalesModel(star.orders, star.customers(), products, star.regions(), fact, PRIMARY)


ORDER_GROUPS = {
    "total": [],
    "region": ["Region"],
    "month": ["Month Start"],
    "type_and_line": ["Customer_Type", "Product_Line"],
    "customer": ["Customer_ID"],
    "year_and_product": ["Year", "Product_ID"],
}
for _label, _keys in ORDER_GROUPS.items():
    register(
        lambda star, keys=_keys: measures.evaluate(model(star), list(measures.ORDER_MEASURES), keys),
        f"order_measures_by_{_label}",
    )
for _label, _keys in {"total": [], "type": ["Customer_Type"], "category": ["Product_Category"]}.items():
    register(
        lambda star, keys=_keys: measures.evaluate(
            model(star), list(measures.ORDER_MEASURES), keys, CHOSEN
        ),
        f"filtered_order_measures_by_{_label}",
    )

PLAIN_FORECAST_MEASURES = [n for n in measures.FORECAST_MEASURES if not n.startswith("Benchmark")]
BENCHMARK_MEASURES = [n for n in measures.FORECAST_MEASURES if n.startswith("Benchmark")]
for _label, _keys in {
    "total": [], "region": ["Region"], "category": ["Product_Category"], "month": ["Month Start"],
    "series": ["Product_ID", "Region_ID"],
}.items():
    register(
        lambda star, keys=_keys: measures.evaluate(model(star, True), PLAIN_FORECAST_MEASURES, keys),
        f"forecast_measures_by_{_label}",
    )
register(
    lambda star: measures.evaluate(model(star, True), BENCHMARK_MEASURES, ["Model", "Region"]),
    "benchmark_measures_by_model_and_region",
)
register(
    lambda star: measures.evaluate(
        model(star, True), ["Total Revenue", "Total Orders", "Total Actual Demand", "WAPE %"], ["Month Start"]
    ),
    "cross_fact_measures_by_month",
)
register(
    lambda star: measures.evaluate(
        model(star, True), ["Total Revenue", "Total Actual Demand", "WAPE %"], ["Customer_Type", "Region"]
    ),
    "cross_fact_measures_by_type_and_region",
)
register(lambda star: measures.calendar(star.orders("Order_Date")), "calendar")

# --- dashboard datasets ------------------------------------------------------------------

for _dataset in (
    datasets.dataset_overview_cards, datasets.dataset_revenue_by_region,
    datasets.dataset_revenue_by_month, datasets.dataset_revenue_by_product_line,
    datasets.dataset_sales_cards, datasets.dataset_top_customers,
    datasets.dataset_revenue_by_customer_type, datasets.dataset_month_type_revenue,
    datasets.dataset_operations_cards, datasets.dataset_on_time_by_region,
    datasets.dataset_delays_by_category, datasets.dataset_service_by_month,
    datasets.dataset_order_details,
):
    register(lambda star, build=_dataset: build(model(star)), _dataset.__name__)
for _dataset in (
    datasets.dataset_forecast_cards, datasets.dataset_actual_vs_forecast,
    datasets.dataset_bias_by_month, datasets.dataset_model_benchmark,
):
    register(lambda star, build=_dataset: build(model(star, True)), _dataset.__name__)

register(lambda star: datasets.dataset_region_type_matrix(model(star)), "dataset_region_type_matrix")
register(
    lambda star: datasets.dataset_category_region_wape(model(star, True)), "dataset_category_region_wape"
)
for _label, _column in datasets.SLICERS.items():
    register(
        lambda star, c=_column: datasets.slicer_values(model(star, c == "forecast_month"), c),
        f"slicer_{_label}",
    )

# --- forest forecast and model selection (not expressible in SQL) ---------------------------

# The parameters that model selection settled on for the established forecast.
SELECTED_DEPTH, SELECTED_LEAF = 12, 3


@register
def random_forest_forecast(star: Star) -> DataFrame:
    """The forecast fact of the selected forest, fitted on all development rows."""
    steps = history(star)
    forest = modeling.rf_candidates(depths=(SELECTED_DEPTH,), leaves=(SELECTED_LEAF,))
    fitted = modeling.fit_selected(forest, assemble(steps.development))
    return modeling.forecast_results(modeling.predict_rf(fitted, assemble(steps.test)))


@register
def model_selection(star: Star) -> DataFrame:
    """Chronological cross-validation of all three learners over small grids."""
    development = assemble(history(star).development)
    candidates = [
        modeling.mean_baseline(),
        modeling.rf_candidates(trees=20, depths=(5, 8), leaves=(1, 3)),
        modeling.boosted_candidates(),
    ]
    searches = modeling.search_all(candidates, development)
    return modeling.cv_results(development, searches)

@register
def mean_baseline_cv(star: Star) -> DataFrame:
    """The cross-validation score of the training mean, fold by fold and on average."""
    development = materialize(assemble(history(star).development), "development")
    scores = modeling.fold_scores(modeling.mean_baseline(), modeling.month_folds(development))
    folds = star.spark.createDataFrame([(fold, mae) for _, fold, mae in scores], "fold int, mae double")
    return folds.select("fold", F.round("mae", 6).alias("mae"), F.round(F.avg("mae").over(Window.partitionBy()), 6).alias("cv_mae"))


@register
def fold_guard(star: Star) -> DataFrame:
    """Which numbers of folds the development months allow, around the largest one."""
    development = materialize(history(star).development.select("Month"), "development-months")
    months = development.select("Month").distinct().count()

    def allowed(folds: int) -> bool:
        try:
            return len(modeling.month_folds(development, folds)) == folds
        except ValueError:
            return False

    rows = [(folds, allowed(folds)) for folds in (1, months // 2, months - 1, months, months + 1)]
    return star.spark.createDataFrame(rows, "folds int, allowed boolean")


@register
def feature_vectors(star: Star) -> DataFrame:
    """The feature vector and label of every test cell, one column per place in the vector."""
    places = vector_to_array("features")
    assembled = assemble(history(star).test).select(*MODEL_CELL, "label", places.alias("x"))
    return assembled.select(*MODEL_CELL, "label", *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(len(MODEL_FEATURES))])


BOOSTED_FITS = (boosting.Fit(10, 15), boosting.Fit(10, 31))


@register
def boosted_first_trees(star: Star) -> DataFrame:
    """Leaves of the first two boosted trees of 15 and of 31 leaves, fitted on all development rows."""
    development = history(star).development
    done = boosting.boost(development, BOOSTED_FITS, MODEL_FEATURES, iterations=2)
    rows = [
        (fit.leaves, number, node, size, value / boosting.SCALE)
        for fit, trees in zip(BOOSTED_FITS, done.leaves)
        for number, tree in enumerate(trees, start=1) for node, (size, value) in tree.items()
    ]
    return star.spark.createDataFrame(rows, "max_leaf_nodes int, tree int, node bigint, rows bigint, value double")


# --- files: typed scans, lenient parsing, named tables, exports ------------------------------


@register
def panel_year_read_back(star: Star) -> DataFrame:
    """The panel written by year, and the last full year read back by pruning."""
    path = scratch_path(star.spark, "panel")
    write_panel(history(star).panel, path)
    back = star.spark.read.parquet(path)
    last = F.col("Year") == 2000
    return back.where(last).select("Month", "Product_ID", "Region_ID", "Actual_Demand", "Year")


def orders_as_csv(star: Star) -> str:
    path = scratch_path(star.spark, "orders-csv")
    write_frame(star.orders(), path, "csv")
    return path


@register
def csv_orders(star: Star) -> DataFrame:
    """The order fact written as CSV and read back with its declared schema."""
    return read_table(star.spark, "sales_orders", orders_as_csv(star))


@register
def csv_orders_cleaned(star: Star) -> DataFrame:
    """The same CSV read as text and parsed leniently."""
    text = read_text_table(star.spark, "sales_orders", orders_as_csv(star))
    dated = parse_dates(text, "Order_Date", strict=False)
    return parse_numbers(
        parse_numbers(dated, ["Quantity", "Delivery_Days"]), ["Unit_Price", "Revenue"], "double"
    )


@register
def csv_forecast(star: Star) -> DataFrame:
    """The forecast fact after a trip through CSV."""
    path = scratch_path(star.spark, "forecast-csv")
    write_forecast(forecast_rows(star), path)
    return read_forecast(star.spark, path)


@register
def registered_tables(star: Star) -> DataFrame:
    """Named tables queried with SQL text."""
    register_sources({"sales_orders": star.orders("Order_Status", "Customer_ID", "Quantity"),
                      "customers": star.customers()})
    return star.spark.sql(
        """SELECT Customer_Type, Order_Status, count(*) AS lines, sum(Quantity) AS units
           FROM sales_orders JOIN customers USING (Customer_ID) GROUP BY Customer_Type, Order_Status"""
    )


@register
def exported_reports(star: Star) -> DataFrame:
    """All 21 reports written and verified; their names and row counts."""
    tables = Tables(star.orders(), star.customers(), star.products(), star.regions(), forecast_rows(star))
    built = {name: build() for name, build in reports(prepared(tables), MODELS, PRIMARY).items()}
    written = export_reports(built, scratch_path(star.spark, "reports"))
    return star.spark.createDataFrame(list(written.items()), "report string, rows bigint")


@register
def one_to_one_join(star: Star) -> DataFrame:
    """Test rows beside the forecast fact, both proven unique per cell first."""
    fact = results(star)
    test = history(star).test.select("Month", "Product_ID", "Region_ID", "Demand_Lag_1", "Demand_Lag_12")
    return quality.join_one_to_one(test, fact, ["Month", "Product_ID", "Region_ID"])
