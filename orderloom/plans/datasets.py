"""Datasets behind the dashboard visuals: calls of the measure layer with slicer filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from orderloom.constants import NAIVE, SEASONAL_NAIVE
from orderloom.plans.measures import (
    CALENDAR_COLUMNS, CUSTOMER_COLUMNS, PRODUCT_COLUMNS, REGION_COLUMNS, Filters, SalesModel,
    calendar, evaluate,
)


def dataset_overview_cards(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    return evaluate(model, ["Total Orders", "Total Revenue", "Active Customers"], (), filters)


def dataset_revenue_by_region(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    return evaluate(model, ["Total Revenue"], ["Region"], filters).orderBy(F.desc("Total Revenue"))


def dataset_revenue_by_month(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    return evaluate(model, ["Total Revenue"], ["Month Start"], filters).orderBy("Month Start")


def dataset_revenue_by_product_line(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    return evaluate(model, ["Total Revenue"], ["Product_Line"], filters).orderBy(F.desc("Total Revenue"))


def dataset_sales_cards(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    measures = ["Active Customers", "Top 10 Customer Revenue %", "Revenue per Customer", "Average Order Value"]
    return evaluate(model, measures, (), filters)


def dataset_top_customers(model: SalesModel, filters: Filters | None = None, n: int = 10) -> DataFrame:
    """Customer names with the n largest revenues, ties at the cut included."""
    revenue = evaluate(model, ["Total Revenue"], ["Customer_Name"], filters)
    leading = Window.orderBy(F.desc_nulls_last("Total Revenue"))
    # the rank filter is pushed below the shuffle, so each task passes on n rows
    top = revenue.withColumn("place", F.rank().over(leading)).where(F.col("place") <= n)
    return top.drop("place").orderBy(F.desc("Total Revenue"), "Customer_Name")


def dataset_revenue_by_customer_type(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    return evaluate(model, ["Total Revenue"], ["Customer_Type"], filters).orderBy(F.desc("Total Revenue"))


# A matrix wider than this is refused, not cut.
MOST_COLUMNS = 1_000


def _across(dimension: DataFrame, column: str) -> list[str]:
    """The sorted values of a dimension that become the columns of a matrix."""
    found = dimension.select(column).where(F.col(column).isNotNull()).distinct().limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"{column} has more than {MOST_COLUMNS} values: name those to show.")
    return sorted(r[0] for r in found)


def dataset_region_type_matrix(
    model: SalesModel, types: Sequence[str] | None = None, filters: Filters | None = None
) -> DataFrame:
    """Formatted revenue, regions down and customer types across: all types unless some are named."""
    types = _across(model.customers, "Customer_Type") if types is None else types
    cells = evaluate(model, ["Revenue Display"], ["Region", "Customer_Type"], filters)
    return cells.groupBy("Region").pivot("Customer_Type", list(types)).agg(F.first("Revenue Display"))


def dataset_month_type_revenue(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    measures = ["Active Customers", "Total Orders", "Average Order Value", "Total Revenue"]
    return evaluate(model, measures, ["Month Start", "Customer_Type"], filters).orderBy(
        "Month Start", "Customer_Type"
    )


def dataset_forecast_cards(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    measures = ["WAPE %", "Forecast MAE", "Forecast RMSE", "Total Actual Demand", "Total Forecast Demand"]
    return evaluate(model, measures, (), filters)


def dataset_actual_vs_forecast(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    measures = ["Total Actual Demand", "Total Forecast Demand"]
    return evaluate(model, measures, ["Month Start"], filters).orderBy("Month Start")


def dataset_category_region_wape(
    model: SalesModel, region_names: Sequence[str] | None = None, filters: Filters | None = None
) -> DataFrame:
    """WAPE, product categories down and regions across: all regions unless some are named."""
    region_names = _across(model.regions, "Region") if region_names is None else region_names
    cells = evaluate(model, ["WAPE %"], ["Product_Category", "Region"], filters)
    return cells.groupBy("Product_Category").pivot("Region", list(region_names)).agg(F.first("WAPE %"))


def dataset_bias_by_month(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    return evaluate(model, ["Forecast Bias %"], ["Month Start"], filters).orderBy("Month Start")


def dataset_model_benchmark(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    order = F.when(F.col("Model") == NAIVE, 2).when(F.col("Model") == SEASONAL_NAIVE, 3).otherwise(1)
    measures = ["Benchmark MAE", "Benchmark RMSE", "Benchmark WAPE %"]
    return evaluate(model, measures, ["Model"], filters).orderBy(order)


def dataset_operations_cards(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    measures = ["Delayed Revenue", "Total Orders", "Average Delivery Days", "On-Time Orders",
                "Delayed Orders", "On-Time Order Rate %"]
    return evaluate(model, measures, (), filters)


def dataset_on_time_by_region(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    measures = ["Total Orders", "Delayed Orders", "Average Delivery Days", "Delayed Revenue",
                "On-Time Order Rate %"]
    return evaluate(model, measures, ["Region"], filters).orderBy("On-Time Order Rate %")


def dataset_delays_by_category(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    measures = ["Delayed Orders", "Delayed Revenue", "Average Delivery Days", "On-Time Unit Rate %",
                "Delayed Order Rate %"]
    return evaluate(model, measures, ["Product_Category"], filters).orderBy(F.desc("Delayed Order Rate %"))


def dataset_service_by_month(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    measures = ["Average Delivery Days", "Delayed Orders", "Delayed Revenue", "Total Orders",
                "On-Time Order Rate %"]
    return evaluate(model, measures, ["Month Start"], filters).orderBy("Month Start")


def dataset_order_details(model: SalesModel, filters: Filters | None = None) -> DataFrame:
    """Orders with customer, category and region, longest deliveries first."""
    keys = ["Order_ID", "Order_Date", "Customer_Name", "Product_Category", "Region"]
    measures = ["Ordered Units", "Total Revenue", "Sum of Delivery Days"]
    return evaluate(model, measures, keys, filters).orderBy(F.desc("Sum of Delivery Days"), *keys)


def slicer_values(model: SalesModel, column: str) -> DataFrame:
    """Distinct values to pick from, for any column that filters accept."""
    if column in CALENDAR_COLUMNS:
        source = calendar(model.orders("Order_Date"))
    elif column in REGION_COLUMNS:
        source = model.regions
    elif column in PRODUCT_COLUMNS:
        source = model.products
    elif column in CUSTOMER_COLUMNS:
        source = model.customers
    elif column == "forecast_month" and model.forecast is not None:
        source = model.forecast.select(F.col("Month").alias("forecast_month"))
    else:
        raise KeyError(f"No slicer for column: {column}")
    return source.select(column).distinct().orderBy(column)


SLICERS: Mapping[str, str] = {
    "customer_type": "Customer_Type",
    "region": "Region",
    "product_category": "Product_Category",
    "product_line": "Product_Line",
    "year_month": "Year Month",
    "forecast_month": "forecast_month",
}
