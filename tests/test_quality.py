import pytest
from pyspark.sql import functions as F

from orderloom.operators import quality
from tests.conftest import by_key
from tests.test_forecast import fact


@pytest.fixture(scope="module")
def orders(make_orders):
    rows = [("a", "2024-07-02", "C1", "P1", "R1", 3, 30, 5), ("b", "2024-07-09", "C2", "P1", "R1", 4, 40, 30),
            ("c", "2025-06-05", "C1", "P1", "R1", 9, 90, 26), ("d", "2025-07-05", "C1", "P1", "R1", 8, 80, 27)]
    return make_orders(rows)


@pytest.fixture(scope="module")
def results(spark):
    return fact(spark, [(7, "P1", "R1", 8, 9, 7, 10), (7, "P2", "R1", 0, 0, 0, 1)])


def failing(table):
    return {r["check"]: r["violations"] for r in table.collect() if r["violations"]}


def test_clean_inputs_pass_every_gate(orders, dims, results):
    gate = quality.input_gate(orders, *dims, results)
    assert len(gate.collect()) == 25
    assert failing(gate) == {}
    quality.enforce(gate)


@pytest.mark.parametrize(
    "change, broken",
    [
        (lambda o: o.unionAll(o.limit(1)), {"order key", "forecast actuals", "seasonal baseline", "naive baseline"}),
        (lambda o: o.withColumn("Order_ID", F.when(F.col("Order_ID") != "a", F.col("Order_ID"))), {"order key"}),
        (lambda o: o.withColumn("Product_ID", F.lit("P9")), {"order products"}),
        (lambda o: o.withColumn("Region_ID", F.lit(None).cast("string")), {"order regions"}),
        (lambda o: o.withColumn("Customer_ID", F.lit("C9")), {"order customers"}),
        (lambda o: o.withColumn("Order_Date", F.lit(None).cast("date")), {"order date"}),
        (lambda o: o.withColumn("Quantity", F.lit(0).cast("bigint")), {"order quantity"}),
        (lambda o: o.withColumn("Revenue", F.lit(float("nan"))), {"order numbers"}),
        (lambda o: o.withColumn("Order_Status", F.lit("Lost")), {"order status", "delivery rule"}),
        (lambda o: o.withColumn("Delivery_Days", F.col("Delivery_Days") + 1), {"delivery rule"}),
        (lambda o: o.limit(0), {"orders not empty"}),
    ],
)
def test_corrupted_orders_are_caught(orders, dims, results, change, broken):
    found = set(failing(quality.input_gate(change(orders), *dims, results)))
    assert found & broken
    if len(broken) == 1 or "order status" in broken:
        assert broken <= found


@pytest.mark.parametrize(
    "column, value, broken",
    [
        ("Month", "date'2025-07-02'", "forecast month"),
        ("Actual_Demand", "-1L", "forecast demand"),
        ("Forecast_Demand", "double('Infinity')", "forecast numbers"),
        ("Squared_Error", "0.5D", "stored errors"),
        ("Naive_Forecast", "99.0D", "naive baseline"),
        ("Seasonal_Naive_Forecast", "99.0D", "seasonal baseline"),
        ("Actual_Demand", "99L", "forecast actuals"),
        ("Product_ID", "'P9'", "forecast products"),
        ("Region_ID", "'R9'", "forecast regions"),
    ],
)
def test_corrupted_forecast_is_caught(orders, dims, results, column, value, broken):
    changed = results.withColumn(column, F.expr(value))
    with pytest.raises(quality.QualityError) as caught:
        quality.enforce(quality.input_gate(orders, *dims, changed))
    assert broken in caught.value.counts


def test_dimension_keys(dims):
    customers, products, regions = dims
    assert quality.check_key(products.unionAll(products.limit(1)), "Product_ID").count() == 1
    assert quality.check_reference(customers, regions.where("Region_ID <> 'R2'"), "Region_ID").count() == 1
    with pytest.raises(quality.QualityError):
        quality.join_one_to_one(products, products.unionAll(products), ["Product_ID"])
    assert quality.join_one_to_one(products, products.select("Product_ID"), ["Product_ID"]).count() == 3


def test_required_columns(orders):
    quality.check_columns(orders, ["Order_ID"])
    with pytest.raises(ValueError, match="Nope"):
        quality.check_columns(orders, ["Order_ID", "Nope"])


def test_quality_report_counts(make_orders):
    orders = make_orders([("a", "2024-01-01", "C", "P", "R", 1, 1, 1), ("a", "2024-01-01", "C", "P", "R", 0, 1, 1),
                          ("a", "2024-01-01", "C", "P", "R", 1, 1, 1), ("b", "2024-01-01", "C", None, "R", -1, 1, 1)])
    undated = orders.withColumn("Order_Date", F.when(F.col("Order_ID") != "b", F.col("Order_Date")))
    required = ["Order_ID", "Order_Date", "Product_ID", "Region_ID", "Quantity"]
    report = quality.quality_report(undated, required)
    assert tuple(report.first()) == (2, 1, 1, 2)
    assert quality.check_quality_report(report).count() == 1
    clean = quality.quality_report(orders.limit(1), required)
    assert quality.check_quality_report(clean).count() == 0
    assert tuple(quality.quality_report(orders.limit(0), required).first()) == (0, 0, 0, 0)


def test_reconciliation_gate(spark):
    frame = spark.createDataFrame([(1, 0), (2, 5)], "m int, absolute_reconciliation_difference bigint")
    assert quality.check_reconciliation(frame).count() == 1


def test_unknown_rule_outcome_counts_as_broken(spark):
    frame = spark.createDataFrame([(None,), (1,)], "Quantity bigint")
    table = by_key(quality.count_broken_rules(frame, {"q": F.col("Quantity") > 0}), "check")
    assert table["q"]["violations"] == 1
    assert quality.check_condition(frame, F.col("Quantity") > 0).count() == 1
