from datetime import date

import pytest
from pyspark.sql import functions as F

from orderloom.operators import quality
from orderloom.operators.features import (
    add_lags, add_rolling, assemble, demand_features, demand_history, drop_warmup, split_final,
)
from orderloom.operators.panel import calendar_features, month_spine, monthly_observed, monthly_panel
from tests.conftest import by_key, rows_of


@pytest.fixture(scope="module")
def gappy(make_orders):
    return make_orders(
        [("1", "2023-01-15", "C1", "P1", "R1", 10, 100, 5),
         ("2", "2023-01-20", "C1", "P1", "R1", 5, 50, 30),
         ("3", "2023-04-01", "C2", "P1", "R1", 7, 70, 5),
         ("4", "2023-02-10", "C2", "P2", "R2", 1, 10, 5)]
    )


def series(spark, values, product="P1", start=(2020, 1)):
    year, month = start
    rows = [
        (date(year + (month - 1 + i) // 12, (month - 1 + i) % 12 + 1, 1), product, "R1", v)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "Month date, Product_ID string, Region_ID string, Actual_Demand bigint")


def test_observed_sums_every_status_and_drops_null_keys(spark, gappy):
    lost = gappy.limit(1).withColumn("Region_ID", F.lit(None).cast("string"))
    observed = by_key(monthly_observed(gappy.unionAll(lost)), "Month", "Product_ID", "Region_ID")
    assert observed[(date(2023, 1, 1), "P1", "R1")]["Actual_Demand"] == 15
    assert len(observed) == 3


def test_panel_is_the_full_zero_filled_grid(gappy):
    panel = by_key(monthly_panel(gappy), "Month", "Product_ID", "Region_ID")
    assert len(panel) == 4 * 2 * 2  # four months, also pairs that never sold
    assert panel[(date(2023, 3, 1), "P1", "R1")]["Actual_Demand"] == 0
    assert panel[(date(2023, 2, 1), "P2", "R1")]["Actual_Demand"] == 0
    cell = panel[(date(2023, 4, 1), "P1", "R1")]
    assert (cell["Actual_Demand"], cell["Year"], cell["Quarter"], cell["Time_Index"]) == (7, 2023, 2, 4)
    assert sum(r["Actual_Demand"] for r in panel.values()) == 23


def test_time_index_counts_from_the_first_year(spark):
    frame = calendar_features(series(spark, [1] * 15, start=(2022, 11)))
    assert [r["Time_Index"] for r in frame.orderBy("Month").collect()][:3] == [11, 12, 13]


def test_month_spine(spark, gappy):
    assert rows_of(month_spine(monthly_observed(gappy)).orderBy("Month")) == [
        (date(2023, m, 1),) for m in (1, 2, 3, 4)
    ]


def test_panel_gate(gappy):
    panel = monthly_panel(gappy)
    assert quality.check_panel(panel).count() == 0
    assert quality.check_panel(panel.where("Month <> date'2023-02-01' OR Product_ID <> 'P1'")).count() == 1
    assert quality.check_panel(panel.where("Month <> date'2023-02-01'")).count() == 1
    assert quality.check_panel(panel.unionAll(panel.limit(1))).count() == 1


def test_lags_and_rolling_means_use_earlier_rows_only(spark):
    frame = add_rolling(add_lags(series(spark, [1, 2, 3, 4, 5, 6, 7]), [1, 3]), [3])
    rows = frame.orderBy("Month").collect()
    assert [r["Demand_Lag_1"] for r in rows] == [None, 1, 2, 3, 4, 5, 6]
    assert [r["Demand_Lag_3"] for r in rows] == [None, None, None, 1, 2, 3, 4]
    assert [r["Demand_Rolling_Mean_3"] for r in rows] == [None, None, None, 2.0, 3.0, 4.0, 5.0]


def test_future_demand_never_changes_earlier_features(spark):
    values = [(i * 37) % 23 for i in range(30)]
    before = demand_features(series(spark, values)).orderBy("Month").collect()
    changed = values[:20] + [v + 1000 for v in values[20:]]
    after = demand_features(series(spark, changed)).orderBy("Month").collect()
    assert before[:20] == after[:20]
    history = [c for c in before[0].asDict() if c.startswith("Demand_")]
    assert [before[20][c] for c in history] == [after[20][c] for c in history]


def test_series_do_not_mix(spark):
    both = series(spark, [1, 2, 3]).unionAll(series(spark, [10, 20, 30], "P2"))
    lagged = by_key(add_lags(both, [1]), "Product_ID", "Month")
    assert lagged[("P2", date(2020, 2, 1))]["Demand_Lag_1"] == 10


def test_warmup_split_and_gate(spark):
    panel = calendar_features(series(spark, list(range(1, 31))))
    usable = drop_warmup(demand_features(panel))
    assert usable.count() == 18
    development, test = split_final(usable)
    assert (development.count(), test.count()) == (12, 6)
    assert quality.check_split(development, test).count() == 0
    assert quality.check_split(test, development).count() == 1
    assert quality.check_split(development.limit(0), test).count() == 1
    assert quality.check_split(development, test.where("Month < date'2022-06-01'")).count() == 1


def test_history_in_one_call_matches_the_steps(spark, make_orders):
    rows = [(str(i), f"20{20 + i // 12}-{i % 12 + 1:02}-03", "C1", "P1", "R1", i + 1, 10, 3) for i in range(30)]
    steps = demand_history(make_orders(rows))
    assert (steps.panel.count(), steps.development.count(), steps.test.count()) == (30, 12, 6)
    vector = assemble(steps.test).orderBy("Month").first()
    assert vector["label"] == 25.0 and len(vector["features"]) == 10
    assert vector["features"][0] == 24.0


def test_empty_orders_give_an_empty_panel(make_orders):
    assert monthly_panel(make_orders([])).count() == 0
