from datetime import date
from decimal import Decimal

import pytest

from orderloom.plans import customers, diagnostics, fulfillment, sales
from tests.conftest import by_key, rows_of


@pytest.fixture(scope="module")
def orders(make_orders):
    return make_orders(
        [("1", "2023-01-15", "C1", "P1", "R1", 10, 100, 5),
         ("1", "2023-01-15", "C1", "P2", "R2", 5, 50, 30),
         ("2", "2023-05-20", "C2", "P1", "R1", 4, 100, 26),
         ("3", "2024-02-10", "C2", "P2", "R2", 1, 110, 27),
         ("4", "2024-03-01", "C3", "P1", "R1", 2, 30, 1),
         ("5", "2024-03-02", "C1", "P1", "R1", 3, 135, 1)]
    )


def test_annual_trend(orders):
    rows = sales.annual_sales_trend(orders).collect()
    assert [r["sales_year"] for r in rows] == [2023, 2024]
    assert rows[0]["total_orders"] == 2 and rows[0]["revenue_yoy_growth_pct"] is None
    assert rows[0]["average_order_value"] == 125.0
    assert rows[1]["total_revenue"] == Decimal("275.00")
    assert rows[1]["revenue_yoy_growth_pct"] == 10.0
    assert rows[1]["units_yoy_growth_pct"] == -68.42


def test_growth_skips_missing_years(make_orders):
    rows = sales.annual_sales_trend(
        make_orders([("1", "2020-01-01", "C1", "P1", "R1", 1, 100, 1),
                     ("2", "2023-01-01", "C1", "P1", "R1", 1, 150, 1)])
    ).collect()
    assert rows[1]["revenue_yoy_growth_pct"] == 50.0


def test_regions_follow_the_order_not_the_customer(orders, dims):
    rows = by_key(sales.regional_sales_contribution(orders, dims[2]), "Region_ID")
    assert set(rows) == {"R1", "R2"}  # no sales in R3, so no row
    assert rows["R1"]["total_revenue"] == Decimal("365.00")
    assert (rows["R1"]["total_orders"], rows["R1"]["active_customers"]) == (4, 3)
    assert (rows["R2"]["total_orders"], rows["R2"]["active_customers"]) == (2, 2)
    assert rows["R1"]["revenue_rank"] == 1 and rows["R2"]["revenue_contribution_pct"] == 30.48


def test_product_running_revenue_breaks_ties_by_id(make_orders, dims):
    tied = make_orders(
        [("1", "2023-01-01", "C1", "P2", "R1", 1, 50, 1), ("2", "2023-01-01", "C1", "P1", "R1", 1, 50, 1),
         ("3", "2023-01-01", "C1", "P3", "R1", 1, 100, 1)]
    )
    rows = sales.product_revenue_contribution(tied, dims[1]).collect()
    assert [r["Product_ID"] for r in rows] == ["P3", "P1", "P2"]
    assert [r["revenue_rank"] for r in rows] == [1, 2, 2]
    assert [r["cumulative_revenue"] for r in rows] == [100, 150, 200]
    assert [r["cumulative_revenue_pct"] for r in rows] == [50.0, 75.0, 100.0]


def test_customer_value(orders, dims):
    rows = by_key(customers.customer_value_ranking(orders, dims[0], dims[2]), "Customer_ID")
    assert set(rows) == {"C1", "C2", "C3"}
    assert rows["C1"]["Region"] == "North" and rows["C1"]["total_orders"] == 2
    assert rows["C1"]["last_order_date"] == date(2024, 3, 2)
    assert [rows[c]["customer_revenue_rank"] for c in ("C1", "C2", "C3")] == [1, 2, 3]


def test_customer_types(orders, dims):
    rows = by_key(customers.customer_type_performance(orders, dims[0]), "Customer_Type")
    assert rows["OEM"]["active_customers"] == 2 and rows["OEM"]["total_orders"] == 4
    assert rows["OEM"]["revenue_per_customer"] == 247.5
    assert rows["Dealer"]["revenue_contribution_pct"] == 5.71


@pytest.mark.parametrize(
    "before, now, band",
    [(0, 10, "New or Returning"), (100, 0, "No Orders in Latest Year"), (100, 110, "High Growth"),
     (100, 90, "At Risk"), (100, 109.99, "Stable"), (100, 90.01, "Stable"), (0, 0, "Stable")],
)
def test_momentum_bands(make_orders, dims, before, now, band):
    rows = [("x", "2023-06-01", "C2", "P1", "R1", 1, 1, 1), ("y", "2024-06-01", "C2", "P1", "R1", 1, 1, 1)]
    if before:
        rows.append(("b", "2023-01-01", "C1", "P1", "R1", 1, before, 1))
    if now:
        rows.append(("n", "2024-01-01", "C1", "P1", "R1", 1, now, 1))
    result = by_key(customers.customer_growth_and_risk(make_orders(rows), dims[0], dims[2]), "Customer_ID")
    assert len(result) == 5  # every customer, buyers or not
    assert result["C1"]["customer_momentum"] == band
    assert (result["C1"]["previous_year"], result["C1"]["latest_year"]) == (2023, 2024)
    if not before:
        assert result["C1"]["revenue_yoy_growth_pct"] is None


def test_market_grid_and_segments(make_orders, dims):
    orders = make_orders(
        [("1", "2023-01-01", "C1", "P1", "R9", 1, 100, 1), ("2", "2024-01-01", "C1", "P1", "R9", 1, 105, 1),
         ("3", "2023-01-01", "C2", "P1", "R9", 1, 10, 1), ("4", "2024-01-01", "C2", "P1", "R9", 1, 10, 1),
         ("5", "2023-01-01", "C3", "P1", "R9", 1, 400, 1), ("6", "2024-01-01", "C3", "P1", "R9", 1, 300, 1)]
    )
    rows = by_key(customers.regional_market_opportunity(orders, dims[0], dims[2]), "Region", "Customer_Type")
    assert len(rows) == 3 * 2
    assert rows[("North", "OEM")]["opportunity_segment"] == "High Growth Market"
    assert rows[("North", "OEM")]["active_customers"] == 1
    assert rows[("South", "OEM")]["opportunity_segment"] == "Expansion Opportunity"
    assert rows[("North", "Dealer")]["opportunity_segment"] == "Defend and Grow"
    assert rows[("South", "Dealer")]["opportunity_segment"] == "No Active Customers"
    empty = rows[("West", "OEM")]
    assert empty["revenue_per_customer"] == 0 and empty["revenue_yoy_growth_pct"] is None
    assert empty["company_revenue_per_customer"] == 138.33


def test_delivery_counts_orders_with_both_statuses_twice(orders):
    rows = by_key(fulfillment.annual_fulfillment_kpi(orders), "sales_year")
    assert (rows[2023]["total_orders"], rows[2023]["on_time_orders"], rows[2023]["delayed_orders"]) == (2, 2, 1)
    assert rows[2023]["average_delivery_days"] == 20.33
    assert rows[2023]["on_time_unit_rate_pct"] == 73.68
    assert rows[2023]["delayed_revenue_exposure_pct"] == 20.0


def test_delivery_without_delays_gives_null_sums(make_orders, dims):
    only = make_orders([("1", "2023-01-01", "C1", "P1", "R1", 1, 10, 3)])
    row = fulfillment.product_fulfillment_bottlenecks(only, dims[1]).first()
    assert row["delayed_orders"] == 0 and row["delayed_units"] is None and row["delayed_revenue"] is None
    assert row["delayed_order_rate_pct"] == 0.0 and row["delayed_unit_rate_pct"] is None


def test_regional_risk_rank(orders, dims):
    rows = by_key(fulfillment.regional_fulfillment_performance(orders, dims[2]), "Region_ID")
    assert rows["R2"]["fulfillment_risk_rank"] == 1 and rows["R2"]["delayed_order_rate_pct"] == 100.0


@pytest.mark.parametrize(
    "report",
    [lambda o, d: sales.annual_sales_trend(o), lambda o, d: sales.regional_sales_contribution(o, d[2]),
     lambda o, d: sales.product_revenue_contribution(o, d[1]),
     lambda o, d: customers.customer_value_ranking(o, d[0], d[2]),
     lambda o, d: customers.customer_type_performance(o, d[0]),
     lambda o, d: fulfillment.annual_fulfillment_kpi(o),
     lambda o, d: fulfillment.product_fulfillment_bottlenecks(o, d[1])],
)
def test_no_orders_no_rows(make_orders, dims, report):
    assert report(make_orders([]), dims).count() == 0


# --- diagnostics -------------------------------------------------------------------


@pytest.fixture(scope="module")
def cells(make_orders):
    return diagnostics.focus(
        make_orders(
            [("1", "2023-01-05", "C1", "P1", "R1", 10, 100, 5), ("2", "2023-01-09", "C2", "P1", "R1", 6, 60, 5),
             ("3", "2023-01-20", "C1", "P1", "R1", 4, 20, 30), ("4", "2023-03-01", "C2", "P1", "R1", 30, 90, 5),
             ("5", "2023-03-01", "C9", "P2", "R2", 1, 9, 5)]
        )
    )


def test_focus_filters_products_and_region(cells):
    assert diagnostics.focus(cells, ["P1"], "R1").count() == 4
    assert diagnostics.focus(cells, ["P2"], "R1").count() == 0


def test_order_diagnostics(cells):
    row = by_key(diagnostics.order_diagnostics(cells), "Month", "Product_ID")[(date(2023, 1, 1), "P1")]
    assert (row["Actual_Demand"], row["Order_Count"], row["Largest_Order"], row["Active_Customers"]) == (20, 3, 10, 2)
    assert row["Largest_Customer_Quantity"] == 14 and row["Largest_Customer_Share_pct"] == 70.0
    assert row["Weighted_Unit_Price"] == 9.0 and row["Largest_Order_Share_pct"] == 50.0


def test_decomposition_uses_the_previous_observed_month_and_adds_up(cells):
    split = diagnostics.demand_decomposition(diagnostics.order_diagnostics(cells))
    rows = by_key(split, "Month", "Product_ID")
    march = rows[(date(2023, 3, 1), "P1")]
    assert march["Demand_Change"] == 10  # against January: February had no orders
    assert march["Order_Count_Contribution"] + march["Order_Size_Contribution"] == pytest.approx(10)
    assert rows[(date(2023, 1, 1), "P1")]["Demand_Change"] is None
    assert diagnostics.change_violations(split).count() == 0
    broken = split.withColumn("Order_Size_Contribution", split["Order_Size_Contribution"] + 1)
    assert diagnostics.change_violations(broken).count() == 1


def test_customer_change_and_statuses(cells):
    change = by_key(diagnostics.customer_change(cells, "2023-01-01", "2023-03-01"), "Customer_ID")
    assert tuple(change["C1"])[1:] == (14, 0, -14) and tuple(change["C2"])[1:] == (6, 30, 24)
    matrix = by_key(diagnostics.status_matrix(cells), "Product_ID", "Month")
    assert matrix[("P1", date(2023, 1, 1))]["Delayed"] == 4
    assert matrix[("P1", date(2023, 3, 1))]["Delayed"] == 0


def test_quantiles_and_top_orders(cells):
    row = by_key(diagnostics.size_quantiles(cells, "2023-03-01"), "Product_ID")["P1"]
    assert row["Median_Quantity"] == 6.0 and row["P95_Quantity"] == pytest.approx(9.6) and row["Max_Quantity"] == 10
    assert [r["Quantity"] for r in diagnostics.largest_orders(cells, 2).collect()] == [30, 10]
    assert rows_of(diagnostics.customer_concentration(cells).where("Product_ID = 'P2'"))[0][-1] == 100.0
