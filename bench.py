"""Time the headline queries and print one JSON line.

Each query runs twice from the raw tables, with nothing cached in between, and the
faster run counts: the first one also pays for compiling its code.

BENCH_SF_DIR names the scale directory, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from checks.catalog import QUERIES
from orderloom.session import local_session

HEADLINE = (
    "annual_sales_trend", "regional_sales_contribution", "product_revenue_contribution",
    "customer_value_ranking", "customer_type_performance", "customer_growth_and_risk",
    "regional_market_opportunity", "forecast_detail", "model_benchmark", "annual_forecast_accuracy",
    "product_forecast_accuracy", "regional_forecast_accuracy", "product_market_forecast_accuracy",
    "monthly_forecast_trend", "series_benchmark_comparison", "repeated_forecast_bias",
    "planning_exceptions", "annual_fulfillment_kpi", "regional_fulfillment_performance",
    "product_fulfillment_bottlenecks", "monthly_demand_fulfillment_reconciliation",
    "demand_features", "order_diagnostics", "size_quantiles", "quality_report",
    "order_measures_by_month", "dataset_top_customers", "dataset_order_details",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "orderloom-bench")
    run(spark, "annual_sales_trend", sf_dir)  # start the JVM's compilers before measuring
    seconds = {name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "orderloom_headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
