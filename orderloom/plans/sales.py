"""Sales reports over the order fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from orderloom.functions.numeric import cents, money, money_sum, pct, ratio, round2
from orderloom.functions.ranking import ranks_and_sums

ANNUAL_COLUMNS = ("Order_ID", "Order_Date", "Quantity", "Revenue")
REGIONAL_COLUMNS = ("Order_ID", "Customer_ID", "Region_ID", "Quantity", "Revenue")
PRODUCT_COLUMNS = ("Order_ID", "Product_ID", "Quantity", "Revenue")


def annual_sales_trend(orders: DataFrame) -> DataFrame:
    """Revenue, units, orders and order value by year, with growth on the previous observed year."""
    yearly = (
        orders.groupBy(F.year("Order_Date").alias("sales_year"))
        .agg(
            money_sum("Revenue").alias("total_revenue"),
            F.sum("Quantity").alias("total_units_sold"),
            F.count_distinct("Order_ID").alias("total_orders"),
        )
        .withColumn("average_order_value", round2(ratio("total_revenue", "total_orders")))
    )
    by_year = Window.orderBy("sales_year")  # one row per calendar year

    def growth(measure: str):
        before = F.lag(measure).over(by_year)
        return round2(pct(F.col(measure) - before, before))

    return yearly.withColumns(
        {
            "revenue_yoy_growth_pct": growth("total_revenue"),
            "units_yoy_growth_pct": growth("total_units_sold"),
        }
    ).orderBy("sales_year")


def regional_sales_contribution(orders: DataFrame, regions: DataFrame) -> DataFrame:
    """Sales by the order's region.

    Counted first per region and customer, then per region: an order has one customer,
    so order counts add up and neither distinct count multiplies the fact's rows.
    """
    per_customer = orders.groupBy("Region_ID", "Customer_ID").agg(
        F.sum(cents("Revenue")).alias("cents"),
        F.sum("Quantity").alias("units"),
        F.count_distinct("Order_ID").alias("orders"),
    )
    sales = (
        per_customer.groupBy("Region_ID")
        .agg(
            money(F.sum("cents")).alias("total_revenue"),
            F.sum("units").alias("total_units_sold"),
            F.sum("orders").alias("total_orders"),
            F.count("Customer_ID").alias("active_customers"),
        )
        .join(regions, "Region_ID")
    )
    everything = Window.partitionBy()  # regions only: a handful of rows
    ranked = Window.orderBy(F.desc("total_revenue"))
    return sales.select(
        "Region_ID", "Region", "total_revenue", "total_units_sold", "total_orders", "active_customers",
        round2(ratio("total_revenue", "total_orders")).alias("average_order_value"),
        round2(pct("total_revenue", F.sum("total_revenue").over(everything))).alias(
            "revenue_contribution_pct"
        ),
        F.dense_rank().over(ranked).cast("bigint").alias("revenue_rank"),
    ).orderBy("revenue_rank", "Region_ID")


def product_revenue_contribution(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sales by product with share, running revenue from the largest down, and rank."""
    sales = orders.groupBy("Product_ID").agg(
        money_sum("Revenue").alias("total_revenue"),
        F.sum("Quantity").alias("total_units_sold"),
        F.count_distinct("Order_ID").alias("total_orders"),
    )
    ranked = ranks_and_sums(
        sales.join(products, "Product_ID"), "revenue_rank", ["total_revenue"], [F.asc("Product_ID")],
        {"cumulative_revenue": "total_revenue"},
    )
    total = F.col("total_cumulative_revenue")
    return ranked.select(
        "Product_ID", "Product_Category", "Product_Line",
        "total_revenue", "total_units_sold", "total_orders",
        round2(ratio("total_revenue", "total_units_sold")).alias("average_selling_price"),
        round2(pct("total_revenue", total)).alias("revenue_contribution_pct"),
        "cumulative_revenue",
        round2(pct("cumulative_revenue", total)).alias("cumulative_revenue_pct"),
        "revenue_rank",
    ).orderBy("revenue_rank", "Product_ID")
