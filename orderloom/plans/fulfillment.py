"""Delivery-status reports.

An order may appear with both statuses. Instead of three distinct counts per group,
which would multiply the fact's rows, lines are first folded to (group, order) with a
flag per status; counting rows and flags then gives all three counts exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.constants import COMPLETED, DELAYED, RANDOM_FOREST
from orderloom.functions.dates import in_dates, month_of
from orderloom.functions.numeric import cents, money, money_sum, pct, ratio, round2
from orderloom.functions.ranking import ranks_and_sums

_BASE = ("Order_ID", "Quantity", "Revenue", "Delivery_Days", "Order_Status")
ANNUAL_COLUMNS = _BASE + ("Order_Date",)
REGIONAL_COLUMNS = _BASE + ("Region_ID",)
PRODUCT_COLUMNS = _BASE + ("Product_ID",)
RECONCILIATION_COLUMNS = ("Order_Date", "Product_ID", "Region_ID", "Quantity", "Order_Status")


def fold_lines(orders: DataFrame) -> DataFrame:
    """One row per order, date, customer, product, region and status, for all reports to share.

    Sums take the place of the lines' figures, `Lines` and `Deliveries` that of their counts.
    """
    keys = ["Order_ID", "Order_Date", "Customer_ID", "Product_ID", "Region_ID", "Order_Status"]
    return orders.groupBy(*keys).agg(
        F.sum("Quantity").alias("Quantity"), money_sum("Revenue").alias("Revenue"),
        F.sum("Delivery_Days").alias("Delivery_Days"), F.count("Delivery_Days").alias("Deliveries"),
        F.count(F.lit(1)).alias("Lines"),
    )


def row_count(orders: DataFrame) -> Column:
    """Number of order lines, whether a row is one or stands for several."""
    return F.sum("Lines") if "Lines" in orders.columns else F.count(F.lit(1))


def _service_levels(orders: DataFrame, group: Column, name: str) -> DataFrame:
    """Orders, units, revenue and days of each group, in total and by status."""
    status = F.col("Order_Status")
    done, late = status == COMPLETED, status == DELAYED
    revenue = cents("Revenue")
    folded = "Deliveries" in orders.columns  # rows that stand for several lines
    deliveries = F.sum("Deliveries") if folded else F.count("Delivery_Days")
    per_order = orders.groupBy(group.alias(name), "Order_ID").agg(
        F.max(done).alias("has_done"),
        F.max(late).alias("has_late"),
        F.sum("Quantity").alias("units"),
        F.sum(F.when(done, F.col("Quantity"))).alias("done_units"),
        F.sum(F.when(late, F.col("Quantity"))).alias("late_units"),
        F.sum(revenue).alias("revenue"),
        F.sum(F.when(late, revenue)).alias("late_revenue"),
        F.sum("Delivery_Days").alias("days"),
        deliveries.alias("deliveries"),
    )
    return per_order.groupBy(name).agg(
        F.count("Order_ID").alias("total_orders"),
        F.count_if(F.col("has_done") & F.col("Order_ID").isNotNull()).alias("on_time_orders"),
        F.count_if(F.col("has_late") & F.col("Order_ID").isNotNull()).alias("delayed_orders"),
        F.sum("units").alias("ordered_units"),
        F.sum("done_units").alias("on_time_units"),
        F.sum("late_units").alias("delayed_units"),
        money(F.sum("revenue")).alias("total_revenue"),
        money(F.sum("late_revenue")).alias("delayed_revenue"),
        round2(ratio(F.sum("days"), F.sum("deliveries"))).alias("average_delivery_days"),
    )


def annual_fulfillment_kpi(orders: DataFrame) -> DataFrame:
    levels = _service_levels(orders, F.year("Order_Date"), "sales_year")
    return levels.select(
        "sales_year", "total_orders", "on_time_orders", "delayed_orders", "ordered_units",
        "on_time_units", "total_revenue", "delayed_revenue", "average_delivery_days",
        round2(pct("on_time_orders", "total_orders")).alias("on_time_order_rate_pct"),
        round2(pct("on_time_units", "ordered_units")).alias("on_time_unit_rate_pct"),
        round2(pct("delayed_revenue", "total_revenue")).alias("delayed_revenue_exposure_pct"),
    ).orderBy("sales_year")


def regional_fulfillment_performance(orders: DataFrame, regions: DataFrame) -> DataFrame:
    levels = _service_levels(orders, F.col("Region_ID"), "Region_ID").join(regions, "Region_ID")
    rated = levels.withColumn("delayed_order_rate_pct", round2(pct("delayed_orders", "total_orders")))
    risk = Window.orderBy(F.desc("delayed_order_rate_pct"))  # one row per region
    return rated.select(
        "Region_ID", "Region", "total_orders", "on_time_orders", "delayed_orders", "ordered_units",
        "on_time_units", "average_delivery_days", "delayed_revenue",
        round2(pct("on_time_orders", "total_orders")).alias("on_time_order_rate_pct"),
        "delayed_order_rate_pct",
        round2(pct("on_time_units", "ordered_units")).alias("on_time_unit_rate_pct"),
        F.dense_rank().over(risk).cast("bigint").alias("fulfillment_risk_rank"),
    ).orderBy("fulfillment_risk_rank", "Region_ID")


def product_fulfillment_bottlenecks(orders: DataFrame, products: DataFrame) -> DataFrame:
    levels = _service_levels(orders, F.col("Product_ID"), "Product_ID").join(products, "Product_ID")
    rated = levels.select(
        "Product_ID", "Product_Category", "Product_Line", "total_orders", "delayed_orders",
        "ordered_units", "delayed_units", "average_delivery_days", "delayed_revenue",
        round2(pct("delayed_orders", "total_orders")).alias("delayed_order_rate_pct"),
        round2(pct("delayed_units", "ordered_units")).alias("delayed_unit_rate_pct"),
    )
    keys = ["delayed_order_rate_pct", "delayed_revenue"]
    ranked = ranks_and_sums(rated, "bottleneck_rank", keys, [F.asc("Product_ID")])
    return ranked.orderBy("bottleneck_rank", "Product_ID")


def monthly_demand_fulfillment_reconciliation(
    orders: DataFrame, detail: DataFrame, primary_model: str = RANDOM_FOREST
) -> DataFrame:
    """Forecast actuals against delivered units by month.

    The evaluated months are read first, so that their dates reach the scan of the order
    fact, which is reduced to month, product and region before it meets the forecast.
    """
    primary = detail.where(F.col("Model") == primary_model)
    first, last = primary.agg(F.min("forecast_month"), F.max("forecast_month")).first()
    status, units = F.col("Order_Status"), F.col("Quantity")
    delivered = (
        orders.where(in_dates(orders, first, F.add_months(F.lit(last).cast("date"), 1)))
        .groupBy(month_of("Order_Date").alias("forecast_month"), "Product_ID", "Region_ID")
        .agg(
            row_count(orders).alias("lines"),
            F.sum(units).alias("units"),
            F.sum(F.when(status == COMPLETED, units).otherwise(0)).alias("done_units"),
            F.sum(F.when(status == DELAYED, units).otherwise(0)).alias("late_units"),
        )
        .withColumnsRenamed({"lines": "total_orders", "units": "ordered_units",
                             "done_units": "on_time_units", "late_units": "delayed_units"})
    )
    counts = ["total_orders", "ordered_units", "on_time_units", "delayed_units"]
    matched = primary.join(delivered, ["forecast_month", "Product_ID", "Region_ID"], "left").fillna(
        0, subset=counts
    )
    gap = F.col("ordered_units") - F.col("Actual_Demand")
    return (
        matched.groupBy("forecast_month")
        .agg(
            F.count(F.lit(1)).alias("evaluated_series"),
            F.sum("Actual_Demand").alias("actual_demand"),
            F.sum("forecast_demand").alias("forecast_demand"),
            *[F.sum(name).alias(name) for name in counts],
            F.sum(gap).alias("reconciliation_difference"),
            F.sum(F.abs(gap)).alias("absolute_reconciliation_difference"),
            F.sum("forecast_error").alias("forecast_variance"),
            pct(F.sum("on_time_units"), F.sum("ordered_units")).alias("on_time_unit_rate_pct"),
        )
        .orderBy("forecast_month")
    )
