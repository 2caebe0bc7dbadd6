"""Tracing forecast errors back to the orders behind a cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from orderloom.constants import CELL_KEYS, COMPLETED, DELAYED, SERIES_KEYS
from orderloom.functions.dates import in_dates, month_of
from orderloom.functions.numeric import cents, money, pct, ratio
from orderloom.operators.quality import check_key, enforce

ORDER_COLUMNS = ("Order_ID", "Order_Date", "Customer_ID", "Product_ID", "Region_ID",
                 "Quantity", "Unit_Price", "Revenue", "Order_Status")


def focus(orders: DataFrame, products: Sequence | None = None, region=None) -> DataFrame:
    """Orders of some products in one region, with their month."""
    kept = orders.withColumn("Month", month_of("Order_Date"))
    if products is not None:
        kept = kept.where(F.col("Product_ID").isin(list(products)))
    if region is not None:
        kept = kept.where(F.col("Region_ID") == region)
    return kept


def customer_monthly(orders: DataFrame) -> DataFrame:
    """Units by month, product, region and customer."""
    return orders.groupBy(*CELL_KEYS, "Customer_ID").agg(F.sum("Quantity").alias("Customer_Quantity"))


def order_diagnostics(orders: DataFrame) -> DataFrame:
    """Order counts, sizes, prices and concentration of each cell.

    The fact is reduced once to cell and customer; the cell's figures, the number of
    customers and the largest customer all come from that one intermediate.
    """
    per_customer = orders.groupBy(*CELL_KEYS, "Customer_ID").agg(
        F.sum("Quantity").alias("units"),
        F.count(F.lit(1)).alias("lines"),
        F.max("Quantity").alias("largest"),
        F.sum(cents("Revenue")).alias("cents"),
    )
    cells = per_customer.groupBy(*CELL_KEYS).agg(
        F.sum("units").alias("Actual_Demand"),
        F.sum("lines").alias("Order_Count"),
        F.max("largest").alias("Largest_Order"),
        F.count("Customer_ID").alias("Active_Customers"),
        money(F.sum("cents")).alias("Revenue"),
        F.max(F.when(F.col("Customer_ID").isNotNull(), F.col("units"))).alias("Largest_Customer_Quantity"),
    )
    return cells.select(
        *CELL_KEYS, "Actual_Demand", "Order_Count",
        ratio("Actual_Demand", "Order_Count").alias("Average_Order_Quantity"),
        "Largest_Order", "Active_Customers", "Revenue",
        ratio("Revenue", "Actual_Demand").alias("Weighted_Unit_Price"),
        pct("Largest_Order", "Actual_Demand").alias("Largest_Order_Share_pct"),
        "Largest_Customer_Quantity",
        pct("Largest_Customer_Quantity", "Actual_Demand").alias("Largest_Customer_Share_pct"),
    )


def customer_concentration(orders: DataFrame) -> DataFrame:
    """Share of the largest customer in each cell."""
    return order_diagnostics(orders).select(
        *CELL_KEYS, "Actual_Demand", "Largest_Customer_Quantity", "Largest_Customer_Share_pct"
    )


def demand_decomposition(diagnostics: DataFrame) -> DataFrame:
    """Split each change since the previous observed month into count and size effects.

    Both effects use the mean of the two months as weight, so they add up to the change.
    Months without orders are skipped here, not filled with zero.
    """
    series = Window.partitionBy(*SERIES_KEYS).orderBy("Month")
    demand, count, size = (
        F.col(c) for c in ("Actual_Demand", "Order_Count", "Average_Order_Quantity")
    )
    demand0, count0, size0 = (F.lag(c).over(series) for c in (demand, count, size))
    return diagnostics.withColumns(
        {
            "Demand_Change": demand - demand0,
            "Order_Count_Contribution": (count - count0) * (size + size0) / 2,
            "Order_Size_Contribution": (size - size0) * (count + count0) / 2,
        }
    )


def focus_test(diagnostics: DataFrame, results: DataFrame) -> DataFrame:
    """Diagnostics of the evaluated cells beside their predictions, one to one.

    Diagnostics have one row per cell by construction; the forecast is checked.
    """
    enforce({"forecast key": check_key(results, *CELL_KEYS)})
    return diagnostics.join(results, [*CELL_KEYS, "Actual_Demand"])


def customer_change(orders: DataFrame, first_month, second_month) -> DataFrame:
    """Units per customer in two months and the change between them."""
    months = {"First_Quantity": first_month, "Second_Quantity": second_month}
    month = F.col("Month")
    dates = {name: F.lit(value).cast("date") for name, value in months.items()}
    units = {
        name: F.sum(F.when(month == date, F.col("Quantity")).otherwise(0)).alias(name)
        for name, date in dates.items()
    }
    ranges = [in_dates(orders, F.trunc(d, "MM"), F.add_months(F.trunc(d, "MM"), 1)) for d in dates.values()]
    return (
        orders.where((ranges[0] | ranges[1]) & month.isin(*dates.values()))
        .groupBy("Customer_ID")
        .agg(*units.values())
        .withColumn("Quantity_Change", F.col("Second_Quantity") - F.col("First_Quantity"))
        .orderBy(F.desc("Quantity_Change"), "Customer_ID")
    )


def largest_orders(orders: DataFrame, n: int = 5) -> DataFrame:
    """The n largest order rows."""
    rows = orders.select("Order_ID", "Order_Date", "Customer_ID", "Quantity", "Unit_Price", "Order_Status")
    ties = ["Order_ID", "Customer_ID", "Order_Date", "Unit_Price", "Order_Status"]
    return rows.orderBy(F.desc("Quantity"), *ties).limit(n)


def status_matrix(orders: DataFrame) -> DataFrame:
    """Units by product and month with one column per status."""
    return (
        orders.groupBy("Product_ID", "Month")
        .pivot("Order_Status", [COMPLETED, DELAYED])
        .agg(F.sum("Quantity"))
        .fillna(0, subset=[COMPLETED, DELAYED])
    )


def size_quantiles(orders: DataFrame, cutoff) -> DataFrame:
    """Median, 95th percentile and maximum order size by product before a date.

    Exact with linear interpolation. Sizes are counted first, so a very large product
    reaches the final step as one row per distinct size and not as all of its orders.
    """
    date = F.lit(cutoff).cast("date")
    end = F.add_months(F.trunc(F.date_sub(date, 1), "MM"), 1)  # of the last month that starts before the date
    sizes = (
        orders.where(in_dates(orders, None, end))
        .groupBy("Product_ID", "Quantity")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    points = F.percentile("Quantity", F.array(F.lit(0.5), F.lit(0.95), F.lit(1.0)), F.col("frequency"))
    return (
        sizes.groupBy("Product_ID")
        .agg(points.alias("points"))
        .select(
            "Product_ID",
            F.col("points")[0].alias("Median_Quantity"),
            F.col("points")[1].alias("P95_Quantity"),
            F.col("points")[2].alias("Max_Quantity"),
        )
    )


def weighted_price(diagnostics: DataFrame) -> DataFrame:
    return diagnostics.select("Product_ID", "Region_ID", "Month", "Weighted_Unit_Price")


def change_violations(decomposed: DataFrame, atol: float = 1e-8) -> DataFrame:
    """Rows whose two contributions do not add up to the change."""
    parts = F.col("Order_Count_Contribution") + F.col("Order_Size_Contribution")
    gap = F.abs(F.col("Demand_Change") - parts)
    return decomposed.where(gap > atol + 1e-7 * F.abs(parts))
