"""Command line: build the forecast fact from orders, or all reports from the tables.

    python -m orderloom forecast --orders ORDERS.csv --out FOLDER
    python -m orderloom reports --data FOLDER --forecast FILE --out FOLDER
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from orderloom.operators import modeling
from orderloom.plans.reports import Tables, run_forecast, run_reports
from orderloom.session import configure
from orderloom.sources.sinks import write_forecast, write_panel
from orderloom.sources.tables import read_forecast, read_table


def main() -> None:
    parser = argparse.ArgumentParser(prog="orderloom")
    commands = parser.add_subparsers(dest="command", required=True)
    forecast = commands.add_parser("forecast", help="orders to panel, features, models and forecast fact")
    forecast.add_argument("--orders", required=True)
    reports = commands.add_parser("reports", help="gate the tables and write all reports")
    reports.add_argument("--data", required=True, help="folder with the order, customer, product, region CSVs")
    reports.add_argument("--forecast", required=True)
    reports.add_argument("--forecast-format", choices=["csv", "parquet"], default="csv")
    for command in (forecast, reports):
        command.add_argument("--out", required=True)
        command.add_argument("--format", choices=["csv", "parquet"], default="csv")
    args = parser.parse_args()

    spark = configure(SparkSession.builder.appName("orderloom").getOrCreate())
    if args.command == "forecast":
        run = run_forecast(read_table(spark, "sales_orders", args.orders))
        write_panel(run.history.panel, f"{args.out}/monthly_demand", args.format)
        write_panel(run.history.features, f"{args.out}/demand_features", args.format)
        write_forecast(run.results, f"{args.out}/model_forecast_results", args.format)
        modeling.cv_results(run.results, run.searches).show(truncate=False)
        run.selected_metrics.show(truncate=False)
        modeling.benchmark_results(run.results).show(truncate=False)
    else:
        names = ("sales_orders", "customers", "products", "regions")
        frames = [read_table(spark, name, f"{args.data}/{name}.csv") for name in names]
        tables = Tables(*frames, read_forecast(spark, args.forecast, args.forecast_format))
        for name, rows in run_reports(tables, args.out, args.format).items():
            print(f"{name}: {rows} rows")


if __name__ == "__main__":
    main()
