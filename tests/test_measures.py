from datetime import date
from decimal import Decimal

import pytest

from orderloom.plans import datasets, measures
from orderloom.plans.measures import SalesModel, evaluate
from tests.conftest import by_key, rows_of
from tests.test_forecast import fact


@pytest.fixture(scope="module")
def model(spark, make_orders, dims):
    rows = [
        ("1", "2023-02-28", "C1", "P1", "R2", 10, 100, 5), ("2", "2023-03-10", "C2", "P2", "R1", 5, 200, 30),
        ("3", "2024-02-29", "C1", "P1", "R2", 4, 150, 5), ("3", "2024-02-29", "C1", "P2", "R2", 4, 50, 30),
        ("4", "2024-03-05", "C3", "P3", "R2", 6, 300, 27), ("5", "2025-02-28", "C2", "P1", "R1", 1, 40, 1),
    ]
    results = fact(spark, [(2, "P1", "R1", 100, 90, 120, 105), (2, "P2", "R2", 0, 5, 0, 5),
                           (3, "P1", "R1", 50, 60, 50, 40)])
    return SalesModel.of(make_orders(rows), *dims, results)


def one(model, names, filters=None):
    return evaluate(model, names, (), filters).first().asDict()


def test_totals(model):
    row = one(model, ["Total Revenue", "Total Orders", "Active Customers", "Average Order Value",
                      "On-Time Orders", "Delayed Orders", "Delayed Revenue", "On-Time Unit Rate %"])
    assert row["Total Revenue"] == Decimal("840.00") and row["Total Orders"] == 5
    assert row["Active Customers"] == 3 and row["Average Order Value"] == 168.0
    assert (row["On-Time Orders"], row["Delayed Orders"]) == (3, 3)  # order 3 has both statuses
    assert row["Delayed Revenue"] == Decimal("550.00") and row["On-Time Unit Rate %"] == 0.5


def test_region_is_the_customers_region(model):
    rows = by_key(evaluate(model, ["Total Revenue", "Total Orders"], ["Region"]), "Region")
    assert rows["North"]["Total Revenue"] == 600 and rows["South"]["Total Revenue"] == 240
    assert rows["North"]["Total Orders"] == 3


def test_contribution_ignores_customer_and_region_filters(model):
    row = one(model, ["Total Revenue", "Revenue Contribution %"], {"Region": ["South"]})
    assert row["Total Revenue"] == 240 and row["Revenue Contribution %"] == pytest.approx(240 / 840)
    kept = one(model, ["Revenue Contribution %"], {"Customer_Type": ["OEM"], "Product_ID": ["P1"]})
    assert kept["Revenue Contribution %"] == pytest.approx(1.0)  # the product filter stays
    rows = by_key(evaluate(model, ["Revenue Contribution %"], ["Year", "Region"]), "Year", "Region")
    assert rows[(2023, "South")]["Revenue Contribution %"] == pytest.approx(200 / 300)


def test_previous_year_shifts_dates_and_keeps_other_filters(model):
    rows = by_key(evaluate(model, ["Total Revenue", "Revenue Previous Year", "Revenue YoY Growth %"], ["Year"]), "Year")
    assert rows[2023]["Revenue Previous Year"] is None
    assert rows[2024]["Revenue Previous Year"] == 300
    assert rows[2024]["Revenue YoY Growth %"] == pytest.approx(200 / 300)
    # only last year's days up to the calendar's end count for 2025: 29 February falls on the 28th
    assert rows[2025]["Revenue Previous Year"] == 200
    months = by_key(evaluate(model, ["Revenue Previous Year"], ["Month Start"]), "Month Start")
    assert months[date(2024, 2, 1)]["Revenue Previous Year"] == 100
    only = one(model, ["Revenue Previous Year"], {"Region": ["South"], "Year": [2024]})
    assert only["Revenue Previous Year"] == 200


def test_group_with_only_a_previous_year_is_kept(spark, make_orders, dims):
    orders = make_orders([("1", "2023-02-01", "C1", "P1", "R1", 1, 10, 1), ("2", "2024-05-01", "C1", "P1", "R1", 1, 5, 1)])
    rows = by_key(
        evaluate(SalesModel.of(orders, *dims), ["Total Revenue", "Revenue Previous Year"], ["Month Start"]),
        "Month Start",
    )
    assert rows[date(2024, 2, 1)]["Total Revenue"] is None
    assert rows[date(2024, 2, 1)]["Revenue Previous Year"] == 10


def test_top_customers_keep_ties(spark, make_orders, dims):
    buyers = spark.createDataFrame(
        [(f"K{i:02}", f"N{i}", "OEM", None, "R1") for i in range(14)],
        "Customer_ID string, Customer_Name string, Customer_Type string, Industry string, Region_ID string",
    )
    # nine customers above, three tied at the cut, two below
    revenue = [100 + i for i in range(9)] + [50, 50, 50] + [1, 2]
    orders = make_orders([(str(i), "2024-01-01", f"K{i:02}", "P1", "R1", 1, v, 1) for i, v in enumerate(revenue)])
    model = SalesModel.of(orders, buyers, dims[1], dims[2])
    row = one(model, ["Top 10 Customer Revenue", "Top 10 Customer Revenue %"])
    assert row["Top 10 Customer Revenue"] == sum(revenue[:12])
    assert row["Top 10 Customer Revenue %"] == pytest.approx(sum(revenue[:12]) / sum(revenue))
    few = one(model, ["Top 10 Customer Revenue"], {"Customer_ID": ["K00", "K13"]})
    assert few["Top 10 Customer Revenue"] == 102
    assert datasets.dataset_top_customers(model).count() == 12
    assert datasets.dataset_top_customers(model, n=3).count() == 3


def test_forecast_measures(model):
    row = one(model, ["Total Actual Demand", "WAPE %", "Forecast Accuracy", "Forecast Bias %", "Forecast MAE",
                      "Planning Exceptions", "Forecast Evaluation Period", "Naive MAE",
                      "MAE Improvement vs Naive %", "Overforecast Observations"])
    assert row["Total Actual Demand"] == 150 and row["WAPE %"] == pytest.approx(20 / 150)
    assert row["Forecast Accuracy"] == pytest.approx(130 / 150) and row["Forecast Bias %"] == 0.0
    assert row["Forecast MAE"] == pytest.approx(20 / 3) and row["Naive MAE"] == pytest.approx(25 / 3)
    assert row["Planning Exceptions"] == 2  # the zero-demand row has no relative error
    assert row["Forecast Evaluation Period"] == "Feb 2025 - Mar 2025"
    assert row["MAE Improvement vs Naive %"] == pytest.approx(0.2)
    assert row["Overforecast Observations"] == 2


def test_customer_filters_do_not_reach_the_forecast(model):
    filters = {"Customer_Type": ["Dealer"], "Product_ID": ["P1"]}
    row = one(model, ["Total Revenue", "Total Actual Demand"], filters)
    assert row["Total Revenue"] is None and row["Total Actual Demand"] == 150
    rows = by_key(evaluate(model, ["Total Revenue", "Total Actual Demand"], ["Customer_Type", "Region"]),
                  "Customer_Type", "Region")
    assert rows[("OEM", "North")]["Total Actual Demand"] == 150
    assert rows[("Dealer", "North")]["Total Actual Demand"] == 150


def test_facts_join_on_shared_groups(model):
    rows = by_key(evaluate(model, ["Total Revenue", "Total Actual Demand"], ["Year Month"]), "Year Month")
    assert rows["2025-02"]["Total Revenue"] == 40 and rows["2025-02"]["Total Actual Demand"] == 100
    assert rows["2025-03"]["Total Revenue"] is None and rows["2023-02"]["Total Actual Demand"] is None


def test_benchmark_by_model_row(model):
    rows = by_key(evaluate(model, ["Benchmark MAE"], ["Model"]), "Model")
    assert rows["Random Forest"]["Benchmark MAE"] == pytest.approx(20 / 3)
    assert rows["Seasonal Naive"]["Benchmark MAE"] == pytest.approx(20 / 3)
    assert rows["Naive Forecast"]["Benchmark MAE"] == pytest.approx(25 / 3)
    assert one(model, ["Benchmark MAE"])["Benchmark MAE"] is None
    assert one(model, ["Benchmark MAE"], {"Model": ["Naive Forecast"]})["Benchmark MAE"] == pytest.approx(25 / 3)


def test_order_measures_repeat_per_model_row(model):
    rows = by_key(evaluate(model, ["Total Revenue", "Benchmark MAE"], ["Model"]), "Model")
    assert len(rows) == 3 and {r["Total Revenue"] for r in rows.values()} == {Decimal("840.00")}
    both = evaluate(model, ["Total Revenue", "Benchmark MAE"], ["Year", "Model"]).collect()
    assert len(both) == 9  # every year beside every model
    assert {r["Benchmark MAE"] for r in both if r["Year"] != 2025} == {None}
    types = by_key(evaluate(model, ["Total Revenue", "Benchmark MAE"], ["Customer_Type", "Model"]),
                   "Customer_Type", "Model")
    assert len(types) == 6 and types[("Dealer", "Naive Forecast")]["Benchmark MAE"] == pytest.approx(25 / 3)


def test_every_measure_evaluates_by_a_shared_group(model):
    frame = evaluate(model, list(measures.MEASURES), ["Product_Category"])
    assert len(measures.MEASURES) == 49  # 48 named measures and the implicit day sum
    assert set(frame.columns) == {"Product_Category", *measures.MEASURES}
    assert {r["Product_Category"] for r in frame.collect()} == {"Cat A", "Cat B"}
    with pytest.raises(KeyError):
        measures.measure("Nope")


def test_calendar(model):
    days = measures.calendar(model.orders("Order_Date"))
    assert days.count() == (date(2025, 2, 28) - date(2023, 2, 28)).days + 1
    row = days.where("Date = date'2024-02-29'").first()
    assert tuple(row)[1:] == (2024, 2, "Feb", "2024-02", "Q1", date(2024, 2, 1))


def test_matrices_and_slicers(model):
    matrix = by_key(datasets.dataset_region_type_matrix(model, ["Dealer", "OEM"]), "Region")
    assert matrix["North"]["OEM"] == "300" and matrix["South"]["Dealer"] is None
    wape = by_key(datasets.dataset_category_region_wape(model, ["North", "South"]), "Product_Category")
    assert wape["Cat A"]["North"] == pytest.approx(0.1) and wape["Cat B"]["South"] is None
    assert rows_of(datasets.slicer_values(model, "Customer_Type")) == [("Dealer",), ("OEM",)]
    assert rows_of(datasets.slicer_values(model, "forecast_month")) == [(date(2025, 2, 1),), (date(2025, 3, 1),)]
    assert datasets.slicer_values(model, "Year Month").count() == 25
    details = datasets.dataset_order_details(model, {"Region": ["North"]}).collect()
    assert [r["Order_ID"] for r in details][0] == "3" and len(details) == 4


def test_unknown_filter_or_group_raises(model):
    for call in (([], {"Customer Type": ["OEM"]}), (["Regoin"], None)):
        with pytest.raises(KeyError):
            evaluate(model, ["Total Revenue"], *call)


def test_region_with_forecast_alone_survives_a_customer_grouping(spark, make_orders, dims):
    orders = make_orders([("1", "2024-02-28", "C1", "P1", "R1", 1, 10, 5)])
    model = SalesModel.of(orders, *dims, fact(spark, [(2, "P1", "R3", 5, 5, 5, 5)]))
    rows = evaluate(model, ["Total Revenue", "Total Actual Demand"], ["Customer_Type", "Region"]).collect()
    assert {(r["Customer_Type"], r["Region"], r["Total Actual Demand"]) for r in rows} == {("OEM", "North", None), (None, "West", 5)}


def test_only_leading_customers_have_a_top_ten(spark, make_orders, dims):
    orders = make_orders([(str(i), "2024-02-28", f"C{i}", "P1", "R1", 1, 100 - min(i, 11), 5) for i in range(14)])
    rows = by_key(evaluate(SalesModel.of(orders, *dims), ["Top 10 Customer Revenue"], ["Customer_ID"]), "Customer_ID")
    assert {k for k, r in rows.items() if r["Top 10 Customer Revenue"] is not None} == {f"C{i}" for i in range(10)}


def test_matrix_shows_every_type_of_the_dimension(model):
    assert datasets.dataset_region_type_matrix(model).columns == ["Region", "Dealer", "OEM"]
