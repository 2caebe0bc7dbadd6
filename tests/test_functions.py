import random
from datetime import date
from decimal import Decimal

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from orderloom.functions import numeric, ranking
from orderloom.functions.dates import month_of, month_sequence, quarter_label
from orderloom.functions.numeric import close_to, is_finite, pct, ratio, round2, short_money
from tests.conftest import rows_of


def test_round2_equals_duckdb(spark):
    values = [n / 1000 for n in range(-4000, 4000)] + [1.005, 2.675, 0.125, -1.005, 1e12 + 0.005, 0.0]
    values += [random.Random(1).uniform(-1e6, 1e6) for _ in range(2000)]
    ours = rows_of(spark.createDataFrame([(v,) for v in values], "v double").select(round2("v")))
    con = duckdb.connect()
    theirs = con.execute("SELECT round(v, 2) FROM (SELECT unnest(?::DOUBLE[]) v)", [values]).fetchall()
    assert ours == theirs


def test_zero_denominators_give_null(spark):
    row = spark.range(1).select(ratio(F.lit(1), F.lit(0)), pct(F.lit(1), F.lit(0)), pct(F.lit(1), F.lit(4)))
    assert rows_of(row) == [(None, None, 25.0)]


@pytest.mark.parametrize(
    "amount, text",
    [("1234567890.00", "1.23B"), ("12345678900000.00", "12345.68B"), ("1255000.00", "1.26M"),
     ("999999.99", "1000.00K"), ("1000.00", "1.00K"), ("999.50", "1000"), ("12.49", "12"),
     ("-5.50", "-6"), (None, None)],
)
def test_short_money(spark, amount, text):
    value = None if amount is None else Decimal(amount)
    frame = spark.createDataFrame([(value,)], "v decimal(38,2)")
    assert rows_of(frame.select(short_money("v"))) == [(text,)]


def test_finite_and_close(spark):
    frame = spark.createDataFrame(
        [(1.0, 1.0), (None, None), (1.0, None), (float("nan"), 1.0), (float("inf"), 1.0), (1.0, 1.1)],
        "a double, b double",
    )
    assert [r[0] for r in rows_of(frame.select(is_finite("a")))] == [True, False, True, False, False, True]
    agree = [r[0] for r in rows_of(frame.select(close_to("a", "b")))]
    assert agree[:3] == [True, True, False] and agree[5] is False


def test_month_helpers(spark):
    frame = spark.createDataFrame([(date(2024, 2, 29),)], "d date")
    row = frame.select(
        month_of("d"), quarter_label("d"), month_sequence(month_of("d"), F.lit(date(2024, 4, 1)))
    ).first()
    assert row[0] == date(2024, 2, 1) and row[1] == "Q1"
    assert row[2] == [date(2024, m, 1) for m in (2, 3, 4)]


def dense(values):
    order = sorted({v for v in values if v is not None}, reverse=True)
    place = {v: i + 1 for i, v in enumerate(order)}
    return {v: place.get(v, len(order) + 1) for v in values}


@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.just(3)), min_size=1, max_size=60))
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_distributed_dense_rank_equals_definition(spark, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    ranked = ranking.dense_rank(frame, "r", ["v"])
    expected = dense(values)
    assert {r["id"]: r["r"] for r in ranked.collect()} == {
        i: expected[v] for i, v in enumerate(values)
    }


def test_dense_rank_on_two_keys_and_heavy_ties(spark):
    rng = random.Random(7)
    rows = [(i, 1 if i % 3 == 0 else rng.randint(0, 400), rng.randint(0, 2)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "id int, a int, b int").repartition(5)
    place = {k: i + 1 for i, k in enumerate(sorted({(a, b) for _, a, b in rows}, reverse=True))}
    ranked = ranking.dense_rank(frame, "r", ["a", "b"])
    assert {r["id"]: r["r"] for r in ranked.collect()} == {i: place[a, b] for i, a, b in rows}


def test_running_sum_equals_definition(spark):
    rng = random.Random(3)
    rows = [(f"P{i:04}", Decimal(rng.choice([0, 5, rng.randint(1, 10**9)])) / 100) for i in range(2000)]
    frame = spark.createDataFrame(rows, "id string, v decimal(18,2)").repartition(7)
    order = [F.desc("v"), F.asc("id")]
    large = ranking.running_sum(frame, "s", "v", order)
    total, expected = Decimal(0), {}
    for key, value in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += value
        expected[key] = total
    assert {r["id"]: r["s"] for r in large.collect()} == expected


def test_money_that_is_no_number_raises(spark):
    for bad in (float("nan"), float("inf"), 1e300):
        frame = spark.createDataFrame([(1.5,), (bad,)], "v double")
        with pytest.raises(Exception, match="not a number"):
            frame.agg(numeric.money_sum("v")).collect()
