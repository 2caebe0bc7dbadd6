"""Physical plans with broadcasting switched off, as on tables too large for it."""

import re

import pytest

from pyspark.sql import DataFrameWriter, functions as F

from checks import catalog
from checks.catalog import QUERIES
from orderloom.operators import panel, quality
from orderloom.plans.reports import Tables, prepared, reports
from orderloom.sources.star import Star

LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def large(spark):
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield spark
    for key in LARGE:
        spark.conf.unset(key)


def executed_plan(frame):
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_distinct_orders_reuse_the_order_join(large, tiny_dir):
    for name in ("annual_sales_trend", "annual_fulfillment_kpi"):
        plan = executed_plan(QUERIES[name](large, tiny_dir))
        by_order = re.findall(r"Exchange hashpartitioning\([^)]*(?:Order_ID|orderkey)[^)]*\)", plan)
        assert len(by_order) == 2, plan  # the two join sides and nothing for the distinct count
        assert "Expand" not in plan


def test_features_sort_each_series_once_without_another_shuffle(large, tiny_dir):
    plan = executed_plan(QUERIES["demand_features"](large, tiny_dir))
    grid = plan.split("Window")[1]
    assert plan.count("Window [") == 1
    before_join = re.split("SortMergeJoin|ShuffledHashJoin", grid)[0]
    assert "Exchange hashpartitioning" not in before_join, plan


@pytest.mark.parametrize(
    "name",
    ["customer_value_ranking", "regional_market_opportunity", "demand_panel", "product_revenue_contribution",
     "order_measures_by_total", "monthly_demand_fulfillment_reconciliation", "overall_summary"],
)
def test_no_cross_joins(large, tiny_dir, name):
    plan = executed_plan(QUERIES[name](large, tiny_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_needed_columns(large, tiny_dir):
    plan = executed_plan(QUERIES["annual_sales_trend"](large, tiny_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    columns = {c.split(":")[0] for schema in schemas for c in schema.split(",")}
    assert columns <= {"l_orderkey", "l_quantity", "l_extendedprice", "o_orderkey", "o_orderdate"}


@pytest.mark.parametrize("name", ["customer_change", "size_quantiles", "monthly_demand_fulfillment_reconciliation"])
def test_date_ranges_reach_the_scan(spark, tiny_dir, name):
    plan = executed_plan(QUERIES[name](spark, tiny_dir))
    scans = re.findall(r"PushedFilters: \[([^\n]*)", plan)
    assert any("LessThan(o_orderdate" in s for s in scans), plan
    if name != "size_quantiles":
        assert any("GreaterThanOrEqual(o_orderdate" in s for s in scans), plan


def test_all_exports_scan_the_fact_three_times(spark, tiny_dir, monkeypatch):
    """The gate's cells, its order keys, and the reduced lines that every report reads."""
    star, plans = Star(spark, tiny_dir), []
    tables = Tables(star.orders(), star.customers(), star.products(), star.regions(), catalog.results(star))
    write = DataFrameWriter.parquet

    def plan(frame):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())

    def recorded(writer, *args, **kwargs):
        plan(writer._df)
        return write(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)

    def scans():
        return sum(len(re.findall(r"Relation \[l_orderkey", p)) for p in plans)

    plan(quality.input_gate(tables.orders, tables.customers, tables.products, tables.regions, tables.results))
    assert scans() == 2
    plans.clear()
    for build in reports(prepared(tables), catalog.MODELS, catalog.PRIMARY).values():
        plan(build())
    assert len(plans) >= 23 and scans() == 1


def test_a_grid_is_dealt_to_as_many_tasks_as_the_session_has_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        left, right = spark.range(200).toDF("a"), spark.range(300).toDF("b")
        pairs = panel.every_pair(left, right)
        assert pairs.count() == 60_000 == pairs.distinct().count()
        blocks = pairs.select(F.pmod(F.hash("a"), F.lit(8)).alias("l"), F.pmod(F.hash("b"), F.lit(8)).alias("r"))
        assert blocks.distinct().count() == 64
        assert len(re.findall(r"explode\(\[0,1,2,3,4,5,6,7\]\)", pairs._jdf.queryExecution().optimizedPlan().toString())) == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_top_customers_are_cut_before_the_shuffle(large, tiny_dir):
    plan = executed_plan(QUERIES["dataset_top_customers"](large, tiny_dir))
    assert re.search(r"WindowGroupLimit.*Partial", plan)
