from datetime import date

import pytest

from orderloom.operators.quality import QualityError
from orderloom.operators.scratch import materialize, recorded_scratch, remove, scratch_root, scratch_scope
from orderloom.plans.reports import Tables, reports, run_reports
from orderloom.session import RUNTIME_SETTINGS, configure
from orderloom.sources.sinks import export_reports, report_names, write_forecast, write_panel
from orderloom.sources.star import ORDER_COLUMNS, Star
from orderloom.sources.tables import (
    parse_dates, parse_numbers, read_forecast, read_table, read_text_table, register_sources,
)
from tests.conftest import rows_of
from tests.test_forecast import fact


def test_csv_with_quotes_and_byte_order_mark(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_bytes('﻿Customer_ID,Customer_Name,Customer_Type,Industry,Region_ID\nC1,"Ann, Bea and Co",OEM,Cars,R1\n'.encode())
    frame = read_table(spark, "customers", str(path))
    assert frame.columns[0] == "Customer_ID"
    assert frame.first()["Customer_Name"] == "Ann, Bea and Co"


def test_strict_dates_fail_and_lenient_dates_become_null(spark, tmp_path):
    path = tmp_path / "orders.csv"
    head = ",".join(ORDER_COLUMNS)
    path.write_text(f"{head}\n1,2024-01-05,C1,P1,R1,3,2.5,7.5,4,Completed\n2,garbage,C1,P1,R1,x,2.5,7.5,4,Completed\n")
    with pytest.raises(Exception):
        read_table(spark, "sales_orders", str(path)).collect()
    text = read_text_table(spark, "sales_orders", str(path))
    cleaned = parse_numbers(parse_dates(text, "Order_Date", strict=False), ["Quantity"])
    assert rows_of(cleaned.select("Order_Date", "Quantity")) == [(date(2024, 1, 5), 3), (None, None)]
    with pytest.raises(Exception):
        parse_dates(text, "Order_Date").select("Order_Date").collect()


def test_forecast_round_trip_keeps_full_precision(spark, tmp_path):
    results = fact(spark, [(7, "P1", "R1", 3, 1, 2, 10 / 3)])
    write_forecast(results, str(tmp_path / "f"))
    again = read_forecast(spark, str(tmp_path / "f"), "csv")
    assert rows_of(again) == rows_of(results)
    write_forecast(results, str(tmp_path / "f.parquet"), "parquet")
    assert rows_of(read_forecast(spark, str(tmp_path / "f.parquet"))) == rows_of(results)


def test_panel_is_partitioned_by_year(spark, tmp_path):
    frame = spark.createDataFrame([(2023, 1), (2024, 2)], "Year int, Actual_Demand int")
    write_panel(frame, str(tmp_path / "panel"))
    assert (tmp_path / "panel" / "Year=2023").is_dir()
    write_panel(frame, str(tmp_path / "panel_csv"), "csv")
    assert spark.read.csv(str(tmp_path / "panel_csv"), header=True).count() == 2


def test_named_tables(spark, dims):
    register_sources({"regions": dims[2]})
    assert spark.sql("SELECT count(*) FROM regions").first()[0] == 3


def test_exports_verify_their_row_counts(spark, tmp_path):
    frames = {"a": spark.range(7), "empty": spark.range(0)}
    assert export_reports(frames, str(tmp_path)) == {"a": 7, "empty": 0}
    assert export_reports(frames, str(tmp_path / "p"), "parquet") == {"a": 7, "empty": 0}
    with pytest.raises(ValueError):
        report_names({})
    with pytest.raises(ValueError):
        report_names({"Bad ": None})


def test_materialize_uses_the_shared_folder(spark, tmp_path):
    root = scratch_root(spark)
    assert spark.conf.get("spark.checkpoint.dir") == root
    stored = materialize(spark.range(5), "five")
    assert stored.count() == 5 and stored.inputFiles()[0].startswith(f"file://{root}")


def test_scopes_remove_what_is_not_kept(spark):
    with recorded_scratch() as left:
        with scratch_scope(spark) as keep:
            gone, kept = materialize(spark.range(3), "gone"), keep(materialize(spark.range(4), "kept"))
            with scratch_scope(spark) as keep_inner:
                materialize(spark.range(1), "inner")
                inner = keep_inner(materialize(spark.range(2), "inner"))
                assert inner.count() == 2
            assert inner.count() == 2 and gone.count() == 3
        assert kept.count() == 4
        for frame in (gone, inner):
            with pytest.raises(Exception):
                frame.collect()
        after = materialize(spark.range(5), "after")
    assert len(left) == 2
    remove(spark, left)
    with pytest.raises(Exception):
        after.collect()
    with pytest.raises(ZeroDivisionError), recorded_scratch() as left, scratch_scope(spark):
        materialize(spark.range(5), "lost")
        1 / 0
    assert not left


def test_settings_respect_explicit_choices(spark):
    key = "spark.sql.adaptive.skewJoin.enabled"
    spark.conf.set(key, "false")
    configure(spark)
    assert spark.conf.get(key) == "false"
    spark.conf.set(key, RUNTIME_SETTINGS[key])


def test_star_joins_only_what_is_asked_for(spark, tiny_dir):
    star = Star(spark, tiny_dir)
    plan = star.orders("Order_ID", "Order_Date")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    full = star.orders()
    assert full.columns == list(ORDER_COLUMNS)
    assert full.count() == star.table("lineitem").count()
    assert full.where("Product_ID IS NULL OR Region_ID IS NULL").count() == 0


@pytest.fixture(scope="module")
def tables(make_orders, dims, spark):
    orders = make_orders(
        [("a", "2024-07-02", "C1", "P1", "R1", 3, 30, 5), ("b", "2024-07-09", "C2", "P1", "R1", 4, 40, 30),
         ("c", "2025-06-05", "C1", "P1", "R1", 9, 90, 26), ("d", "2025-07-05", "C1", "P1", "R1", 8, 80, 27)]
    )
    results = fact(spark, [(7, "P1", "R1", 8, 9, 7, 10), (7, "P2", "R1", 0, 0, 0, 1)])
    return Tables(orders, *dims, results)


def test_all_reports_run_from_gates_to_files(tables, tmp_path):
    written = run_reports(tables, str(tmp_path))
    assert len(written) == 21 == len(reports(tables))
    assert written["forecast_detail"] == 6 and written["planning_exceptions"] == 2
    assert written["customer_growth_and_risk"] == 5 and written["annual_sales_trend"] == 2
    assert written["regional_market_opportunity"] == 6


def test_nothing_is_written_when_a_gate_fails(tables, tmp_path):
    broken = Tables(tables.orders.unionAll(tables.orders), tables.customers, tables.products, tables.regions, tables.results)
    with pytest.raises(QualityError):
        run_reports(broken, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
