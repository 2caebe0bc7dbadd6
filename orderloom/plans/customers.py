"""Customer and market reports.

Every report first reduces the fact to customers (or customers and years), so the
customer dimension is joined at customer grain and not at fact grain, and one very
large customer is a few partial sums instead of a skewed join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from orderloom.constants import (
    MARKET_FLAT, MARKET_HIGH, MARKET_LABELS, MOMENTUM_HIGH, MOMENTUM_LABELS, MOMENTUM_LOW,
)
from orderloom.functions.numeric import MONEY, money_sum, pct, ratio, round2
from orderloom.functions.ranking import ranks_and_sums
from orderloom.operators.panel import every_pair
from orderloom.operators.scratch import materialize

VALUE_COLUMNS = ("Order_ID", "Order_Date", "Customer_ID", "Quantity", "Revenue")
TYPE_COLUMNS = ("Order_ID", "Customer_ID", "Quantity", "Revenue")
YEARLY_COLUMNS = ("Order_Date", "Customer_ID", "Revenue")


def _per_customer(orders: DataFrame, *extra) -> DataFrame:
    return orders.groupBy("Customer_ID").agg(
        money_sum("Revenue").alias("total_revenue"),
        F.sum("Quantity").alias("total_units_sold"),
        F.count_distinct("Order_ID").alias("total_orders"),
        *extra,
    )


def customer_value_ranking(orders: DataFrame, customers: DataFrame, regions: DataFrame) -> DataFrame:
    """Every buying customer by revenue, in the customer's own region."""
    value = (
        _per_customer(orders, F.max("Order_Date").alias("last_order_date"))
        .join(customers, "Customer_ID")
        .join(regions, "Region_ID")
    )
    ranked = ranks_and_sums(
        value, "customer_revenue_rank", ["total_revenue"], [F.asc("Customer_ID")], {"running": "total_revenue"}
    )
    return ranked.select(
        "Customer_ID", "Customer_Name", "Customer_Type", "Region",
        "total_revenue", "total_units_sold", "total_orders",
        round2(ratio("total_revenue", "total_orders")).alias("average_order_value"),
        "last_order_date",
        round2(pct("total_revenue", "total_running")).alias("revenue_contribution_pct"),
        "customer_revenue_rank",
    ).orderBy("customer_revenue_rank", "Customer_ID")


def customer_type_performance(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales by customer type, summed from customer grain."""
    segments = (
        _per_customer(orders)
        .join(customers.select("Customer_ID", "Customer_Type"), "Customer_ID")
        .groupBy("Customer_Type")
        .agg(
            F.count(F.lit(1)).alias("active_customers"),
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_units_sold").alias("total_units_sold"),
            F.sum("total_revenue").alias("total_revenue"),
        )
    )
    everything = Window.partitionBy()  # one row per customer type
    ranked = Window.orderBy(F.desc("total_revenue"))
    return segments.withColumns(
        {
            "revenue_per_customer": round2(ratio("total_revenue", "active_customers")),
            "average_order_value": round2(ratio("total_revenue", "total_orders")),
            "revenue_contribution_pct": round2(
                pct("total_revenue", F.sum("total_revenue").over(everything))
            ),
            "segment_revenue_rank": F.dense_rank().over(ranked).cast("bigint"),
        }
    ).orderBy("segment_revenue_rank", "Customer_Type")


def _latest_two_years(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Customer revenue in the latest observed year and the one before it.

    The year-grain sums are stored once because the latest year is known only after
    all of them; returns the per-customer frame and the one-row period frame.
    """
    yearly = materialize(
        orders.groupBy("Customer_ID", F.year("Order_Date").alias("year")).agg(
            money_sum("Revenue").alias("revenue")
        ),
        "customer-years",
    )
    period = yearly.agg(F.max("year").alias("latest_year"))
    latest = period.scalar()
    is_latest, is_previous = F.col("year") == latest, F.col("year") == latest - 1
    recent = (
        yearly.where(is_latest | is_previous)
        .groupBy("Customer_ID")
        .agg(
            F.sum(F.when(is_previous, F.col("revenue"))).alias("previous_sum"),
            F.sum(F.when(is_latest, F.col("revenue"))).alias("latest_sum"),
            F.max(is_latest.cast("int")).alias("bought_latest"),
        )
    )
    return recent, period


def _growth_columns(period: DataFrame) -> dict:
    """Years, zero-filled revenues and growth; no growth where last year's sum is NULL or 0."""
    latest = period.scalar()
    now, before = (F.coalesce(c, F.lit(0).cast(MONEY)) for c in ("latest_sum", "previous_sum"))
    return {
        "previous_year": latest - 1,
        "latest_year": latest,
        "previous_year_revenue": before,
        "latest_year_revenue": now,
        "revenue_yoy_growth_pct": round2(pct(now - before, F.col("previous_sum"))),
    }


def customer_growth_and_risk(orders: DataFrame, customers: DataFrame, regions: DataFrame) -> DataFrame:
    """Every customer's latest-year growth and momentum band, buyers or not."""
    recent, period = _latest_two_years(orders)
    rows = (
        customers.join(regions, "Region_ID")
        .join(recent, "Customer_ID", "left")
        .withColumns(_growth_columns(period))
    )
    growth = F.col("revenue_yoy_growth_pct")
    before, now = F.col("previous_year_revenue"), F.col("latest_year_revenue")
    momentum = (
        F.when((before == 0) & (now > 0), MOMENTUM_LABELS["new"])
        .when((now == 0) & (before > 0), MOMENTUM_LABELS["lost"])
        .when(growth >= MOMENTUM_HIGH, MOMENTUM_LABELS["high"])
        .when(growth <= MOMENTUM_LOW, MOMENTUM_LABELS["risk"])
        .otherwise(MOMENTUM_LABELS["stable"])
    )
    return rows.select(
        "Customer_ID", "Customer_Name", "Customer_Type", "Region", "previous_year", "latest_year",
        "previous_year_revenue", "latest_year_revenue", "revenue_yoy_growth_pct",
        momentum.alias("customer_momentum"),
    ).orderBy(F.desc_nulls_last("revenue_yoy_growth_pct"), F.desc("latest_year_revenue"), "Customer_ID")


def regional_market_opportunity(orders: DataFrame, customers: DataFrame, regions: DataFrame) -> DataFrame:
    """Every customer region and type pair, empty ones included, against the company average."""
    recent, period = _latest_two_years(orders)
    observed = (
        customers.select("Customer_ID", "Customer_Type", "Region_ID")
        .join(recent, "Customer_ID", "left")
        .groupBy("Region_ID", "Customer_Type")
        .agg(
            F.count_if(F.col("bought_latest") == 1).alias("active"),
            F.sum("previous_sum").alias("previous_sum"),
            F.sum("latest_sum").alias("latest_sum"),
        )
    )
    types = customers.select("Customer_Type").where("Customer_Type IS NOT NULL").distinct()
    grid = every_pair(regions.select("Region_ID", "Region"), types)
    markets = (
        grid.join(observed, ["Region_ID", "Customer_Type"], "left")
        .withColumn("active_customers", F.coalesce("active", F.lit(0).cast("bigint")))
        .withColumns(_growth_columns(period))
        .withColumn(
            "revenue_per_customer",
            F.coalesce(round2(ratio("latest_year_revenue", "active_customers")), F.lit(0.0)),
        )
    )
    everything = Window.partitionBy()  # regions times customer types
    average = ratio(
        F.sum("latest_year_revenue").over(everything), F.sum("active_customers").over(everything)
    )
    growth = F.col("revenue_yoy_growth_pct")
    segment = (
        F.when(F.col("active_customers") == 0, MARKET_LABELS["none"])
        .when(growth >= MARKET_HIGH, MARKET_LABELS["high"])
        .when(
            (growth <= MARKET_FLAT) & (F.col("revenue_per_customer") < F.col("average")),
            MARKET_LABELS["expand"],
        )
        .when(growth <= MARKET_FLAT, MARKET_LABELS["defend"])
        .otherwise(MARKET_LABELS["stable"])
    )
    return (
        markets.withColumn("average", average)
        .select(
            "Region", "Customer_Type", "previous_year", "latest_year", "active_customers",
            "previous_year_revenue", "latest_year_revenue", "revenue_per_customer",
            "revenue_yoy_growth_pct",
            round2("average").alias("company_revenue_per_customer"),
            round2(F.col("average") - F.col("revenue_per_customer")).alias("revenue_per_customer_gap"),
            segment.alias("opportunity_segment"),
        )
        .orderBy(
            F.desc_nulls_last("revenue_yoy_growth_pct"),
            F.desc_nulls_last("revenue_per_customer_gap"),
            "Region", "Customer_Type",
        )
    )
