"""Data-quality gates as distributed checks.

Every check returns the violating rows (or one summary row), so a failing input can be
looked at and not only counted. `enforce` counts all checks in one job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.constants import (
    CELL_KEYS, COMPLETED, DELAYED, HISTORY_COLUMNS, MODEL_COLUMNS, ON_TIME_MAX_DAYS, TEST_MONTHS,
)
from orderloom.functions.dates import month_of
from orderloom.functions.numeric import close_to, is_finite, pct, ratio
from orderloom.operators.scratch import materialize


class QualityError(ValueError):
    """At least one gate found violations; `counts` maps gate name to their number."""

    def __init__(self, counts: Mapping[str, int]):
        self.counts = dict(counts)
        super().__init__("Failed checks: " + ", ".join(f"{k} ({v})" for k, v in self.counts.items()))


def count_violations(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check with its number of violating rows."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def count_broken_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per row-level rule with the rows breaking it, all from a single scan.

    A rule whose outcome is unknown (NULL) counts as broken.
    """
    broken = [
        F.struct(
            F.lit(name).alias("check"),
            F.count_if(~F.coalesce(rule, F.lit(False))).alias("violations"),
        )
        for name, rule in rules.items()
    ]
    return df.agg(F.array(*broken).alias("rules")).select(F.inline("rules"))


def enforce(counts: DataFrame | Mapping[str, DataFrame]) -> None:
    """Raise if any check, given as counts or as violation frames, is not clean."""
    table = counts if isinstance(counts, DataFrame) else count_violations(counts)
    failed = table.where("violations > 0").collect()  # one row per check
    if failed:
        raise QualityError({row["check"]: row["violations"] for row in failed})


# --- structure -----------------------------------------------------------------


def check_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Metadata only: raise if a column is missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def check_not_empty(df: DataFrame) -> DataFrame:
    """One row if the frame has no rows."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("rows")).where("rows = 0")


def check_key(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that repeat or contain NULL, with their row count."""
    has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > 1) | has_null)


def check_reference(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Key values of the fact that the dimension lacks, with their row count.

    The fact is counted per key before it meets the dimension.
    """
    used = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dimension.select(key), key, "left_anti")


def join_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join that first proves both sides unique on the keys."""
    enforce({"left keys": check_key(left, *keys), "right keys": check_key(right, *keys)})
    return left.join(right, list(keys))


# --- values --------------------------------------------------------------------


def quality_report(orders: DataFrame, required: Sequence[str]) -> DataFrame:
    """Counts of repeated ids, incomplete rows, unreadable dates and non-positive quantities.

    Rows are folded to one per id first, so the id count needs no second pass.
    """
    incomplete = reduce(Column.__or__, [F.col(c).isNull() for c in required])
    per_id = orders.groupBy("Order_ID").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(incomplete).alias("incomplete"),
        F.count_if(F.col("Order_Date").isNull()).alias("undated"),
        F.count_if(F.col("Quantity") <= 0).alias("non_positive"),
    )
    zero = F.lit(0).cast("bigint")
    return per_id.agg(
        F.coalesce(F.sum(F.col("rows") - 1), zero).alias("duplicate_order_ids"),
        F.coalesce(F.sum("incomplete"), zero).alias("missing_required_values"),
        F.coalesce(F.sum("undated"), zero).alias("invalid_dates"),
        F.coalesce(F.sum("non_positive"), zero).alias("non_positive_quantity"),
    )


def check_quality_report(report: DataFrame) -> DataFrame:
    """The report's row if any of its counts is above zero."""
    return report.where(reduce(Column.__or__, [F.col(c) > 0 for c in report.columns]))


def check_condition(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition does not hold (unknown counts as not holding)."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def finite_rule(*columns: str) -> Column:
    return reduce(Column.__and__, [is_finite(c) for c in columns])


def delivery_rule() -> Column:
    """Completed within the on-time days, delayed beyond them."""
    status, days = F.col("Order_Status"), F.col("Delivery_Days")
    return ((status == COMPLETED) & (days <= ON_TIME_MAX_DAYS)) | (
        (status == DELAYED) & (days > ON_TIME_MAX_DAYS)
    )


def order_rules() -> dict[str, Column]:
    """Row-level rules of the order fact."""
    return {
        "order date": F.col("Order_Date").isNotNull(),
        "order numbers": finite_rule("Quantity", "Revenue", "Delivery_Days"),
        "order quantity": F.col("Quantity") > 0,
        "order status": F.col("Order_Status").isin(COMPLETED, DELAYED),
        "delivery rule": delivery_rule(),
    }


def stored_errors_rule() -> Column:
    """Stored errors equal forecast minus actual, its absolute value and its square."""
    error = F.col("Forecast_Demand") - F.col("Actual_Demand")
    return (
        close_to("Forecast_Error", error)
        & close_to("Absolute_Error", F.abs(error))
        & close_to("Squared_Error", error * error)
    )


def forecast_rules() -> dict[str, Column]:
    """Row-level rules of the forecast fact."""
    return {
        "forecast month": F.col("Month") == F.trunc("Month", "MM"),
        "forecast numbers": finite_rule("Actual_Demand", *MODEL_COLUMNS.values()),
        "forecast demand": F.col("Actual_Demand") >= 0,
        "stored errors": stored_errors_rule(),
    }


# --- forecast fact -------------------------------------------------------------


def _demand_lookup(results: DataFrame, observed: DataFrame, column: str, months_back: int) -> DataFrame:
    """Forecast rows beside the demand observed `months_back` earlier, 0 when there was none."""
    shifted = observed.select(
        F.add_months("Month", months_back).alias("Month"), "Product_ID", "Region_ID",
        F.col("Actual_Demand").alias("observed"),
    )
    first, last = (results.agg(f("Month")).scalar() for f in (F.min, F.max))
    needed = shifted.where(F.col("Month").between(first, last))
    return results.select(*CELL_KEYS, F.col(column).alias("stored")).join(
        needed, CELL_KEYS, "left"
    ).withColumn("observed", F.coalesce("observed", F.lit(0)))


def check_actuals(results: DataFrame, observed: DataFrame) -> DataFrame:
    """Forecast rows whose actual demand is not what the orders add up to (`monthly_observed`)."""
    rows = _demand_lookup(results, observed, "Actual_Demand", 0)
    return check_condition(rows, close_to("stored", "observed"))


def check_baseline(results: DataFrame, observed: DataFrame, column: str, months: int) -> DataFrame:
    """Rows whose baseline is not the demand observed so many months earlier."""
    rows = _demand_lookup(results, observed, column, months)
    return check_condition(rows, close_to("stored", "observed"))


def panel_reconciliation(panel: DataFrame, observed: DataFrame) -> DataFrame:
    """Cells in which the panel and the orders differ, seen from either side.

    A cell is wrong if the panel lacks it, holds it more than once or holds another demand
    than the orders add up to; without orders the demand is 0. Both sides are counted
    per cell in one grouping, so repeated rows show as well.
    """
    none = F.lit(None).cast("bigint")

    def side(df: DataFrame, name: str) -> DataFrame:
        own, other = F.col("Actual_Demand").cast("bigint"), ("orders" if name == "panel" else "panel")
        return df.select(
            *CELL_KEYS, own.alias(f"{name}_demand"), F.lit(1).alias(f"{name}_rows"),
            none.alias(f"{other}_demand"), F.lit(0).alias(f"{other}_rows"),
        )

    cells = side(panel, "panel").unionByName(side(observed, "orders")).groupBy(*CELL_KEYS).agg(
        *[F.sum(f"{n}_{c}").cast("bigint").alias(f"{n}_{c}") for n in ("panel", "orders") for c in ("demand", "rows")]
    )
    same = F.coalesce("panel_demand", F.lit(0)) == F.coalesce("orders_demand", F.lit(0))
    return check_condition(cells, (F.col("panel_rows") == 1) & (F.col("orders_rows") <= 1) & same)


# --- panel and split -----------------------------------------------------------


def panel_report(panel: DataFrame) -> DataFrame:
    """Size and completeness of a panel in one row."""
    cells = panel.groupBy(*CELL_KEYS).agg(F.count(F.lit(1)).alias("rows"))
    series = cells.groupBy("Product_ID", "Region_ID").agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("rows") > 1).alias("repeated")
    )
    months = panel.select("Month").distinct()
    spine = F.months_between(F.max("Month"), F.min("Month")).cast("bigint") + 1
    return series.agg(
        F.sum("rows").alias("panel_rows"),
        F.count_distinct("Product_ID").alias("products"),
        F.count_distinct("Region_ID").alias("regions"),
        F.sum("repeated").alias("repeated_cells"),
    ).withColumns(
        {"months": months.agg(F.count("Month")).scalar(), "spine_months": months.agg(spine).scalar()}
    )


def check_panel(panel: DataFrame) -> DataFrame:
    """The report's row if the panel is not the full, duplicate-free grid."""
    expected = F.col("months") * F.col("products") * F.col("regions")
    complete = (
        (F.col("panel_rows") == expected)
        & (F.col("repeated_cells") == 0)
        & (F.col("months") == F.col("spine_months"))
    )
    return check_condition(panel_report(panel), complete)


def split_report(
    development: DataFrame, test: DataFrame, columns: Sequence[str] = HISTORY_COLUMNS
) -> DataFrame:
    """Row counts, month ranges and incomplete rows of both sides, one row per side."""
    incomplete = reduce(Column.__or__, [F.col(c).isNull() for c in columns])

    def side(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("Month").alias("first_month"),
            F.max("Month").alias("last_month"),
            F.count_distinct("Month").alias("months"),
            F.count_if(incomplete).alias("incomplete_rows"),
        ).select(F.lit(name).alias("side"), "*")

    return side("development", development).unionAll(side("test", test))


def check_split(development: DataFrame, test: DataFrame, months: int = TEST_MONTHS) -> DataFrame:
    """Sides that are empty, incomplete, out of order or of the wrong length."""
    is_test = F.col("side") == "test"
    report = split_report(development, test)
    facts = report.agg(
        F.min(F.col("rows")).alias("smallest"),
        F.sum("incomplete_rows").alias("incomplete_rows"),
        F.max(F.when(~is_test, F.col("last_month"))).alias("development_end"),
        F.min(F.when(is_test, F.col("first_month"))).alias("test_start"),
        F.max(F.when(is_test, F.col("months"))).alias("test_months"),
    )
    sound = (
        (F.col("smallest") > 0)
        & (F.col("incomplete_rows") == 0)
        & (F.col("development_end") < F.col("test_start"))
        & (F.col("test_months") == months)
    )
    return check_condition(facts, sound)


# --- results -------------------------------------------------------------------


def check_row_ratio(detail: DataFrame, results: DataFrame, models: int = len(MODEL_COLUMNS)) -> DataFrame:
    """One row if the detail does not have one row per observation and model."""
    counts = detail.agg(F.count(F.lit(1)).alias("detail_rows")).withColumn(
        "result_rows", results.agg(F.count(F.lit(1))).scalar()
    )
    return counts.where(F.col("detail_rows") != models * F.col("result_rows"))


def recomputed_metrics(results: DataFrame, models: Mapping[str, str] = MODEL_COLUMNS) -> DataFrame:
    """Each model's metrics straight from the wide fact, a path independent of the detail."""
    actual, rows = F.col("Actual_Demand"), F.count(F.lit(1))
    parts = []
    for label, column in models.items():
        error = F.col(column) - actual
        parts.append(
            F.struct(
                F.lit(label).alias("Model"),
                ratio(F.sum(F.abs(error)), rows).alias("mae"),
                F.sqrt(ratio(F.sum(error * error), rows)).alias("rmse"),
                pct(F.sum(F.abs(error)), F.sum(actual)).alias("wape_pct"),
                ratio(F.sum(error), rows).alias("mean_bias"),
            )
        )
    return results.agg(F.array(*parts).alias("m")).select(F.inline("m"))


def check_metrics(
    benchmark: DataFrame, results: DataFrame, models: Mapping[str, str] = MODEL_COLUMNS
) -> DataFrame:
    """Models whose reported metrics differ from the independent recomputation."""
    names = ["mae", "rmse", "wape_pct", "mean_bias"]
    again = recomputed_metrics(results, models).select(
        "Model", *[F.col(n).alias(f"again_{n}") for n in names]
    )
    agree = reduce(Column.__and__, [close_to(n, f"again_{n}", atol=1e-9) for n in names])
    return check_condition(again.join(benchmark.select("Model", *names), "Model", "left"), agree)


def grouped_totals(views: Mapping[str, DataFrame]) -> DataFrame:
    """Observations and error sums per accuracy view and model."""
    totals = [
        view.groupBy("Model").agg(
            F.sum("observation_count").alias("observations"),
            F.sum("absolute_error_sum").alias("absolute_error"),
            F.sum("squared_error_sum").alias("squared_error"),
        ).select(F.lit(name).alias("view"), "*")
        for name, view in views.items()
    ]
    return reduce(DataFrame.unionAll, totals)


def check_grouped_totals(views: Mapping[str, DataFrame], benchmark: DataFrame) -> DataFrame:
    """View totals that do not add up to the overall benchmark."""
    overall = benchmark.select(
        "Model", F.col("observation_count").alias("n"),
        F.col("absolute_error_sum").alias("a"), F.col("squared_error_sum").alias("s"),
    )
    agree = (
        close_to("observations", "n") & close_to("absolute_error", "a") & close_to("squared_error", "s")
    )
    return check_condition(grouped_totals(views).join(overall, "Model", "left"), agree)


def check_reconciliation(reconciliation: DataFrame) -> DataFrame:
    """Months whose orders and forecast actuals differ."""
    return reconciliation.where(F.col("absolute_reconciliation_difference") != 0)


# --- the two gate sets ---------------------------------------------------------


def order_cells(orders: DataFrame) -> DataFrame:
    """Rows, units and rows that break each order rule, per month, product, region and customer.

    One scan of the fact answers every question that is not about single orders. Counts
    are part of the grouping and not side effects of it, so a task that runs twice counts
    once.
    """
    keys = [month_of("Order_Date").alias("Month"), "Product_ID", "Region_ID", "Customer_ID"]
    broken = [
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"broken_{i}") for i, rule in enumerate(order_rules().values())
    ]
    return orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum("Quantity").alias("Actual_Demand"), *broken)


def observed_demand(cells: DataFrame) -> DataFrame:
    """`monthly_observed` from order cells."""
    return cells.dropna(subset=CELL_KEYS).groupBy(*CELL_KEYS).agg(F.sum("Actual_Demand").alias("Actual_Demand"))


def broken_order_rules(cells: DataFrame) -> DataFrame:
    """`count_broken_rules` of the order rules from order cells."""
    names = list(order_rules())
    counts = [
        F.struct(F.lit(name).alias("check"), F.coalesce(F.sum(f"broken_{i}"), F.lit(0)).alias("violations"))
        for i, name in enumerate(names)
    ]
    return cells.agg(F.array(*counts).alias("rules")).select(F.inline("rules"))


def input_gate(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    regions: DataFrame,
    results: DataFrame,
) -> DataFrame:
    """Violations of everything that must hold before any report is computed.

    The order fact is scanned twice: once for its cells, which answer the row-level rules,
    the references and the demand comparisons, and once for its keys.
    """
    cells = materialize(order_cells(orders), "order-cells")
    observed = materialize(observed_demand(cells), "monthly-observed")
    keyed = {
        "orders not empty": check_not_empty(cells),
        "forecast not empty": check_not_empty(results),
        "order key": check_key(orders, "Order_ID"),
        "customer key": check_key(customers, "Customer_ID"),
        "product key": check_key(products, "Product_ID"),
        "region key": check_key(regions, "Region_ID"),
        "forecast key": check_key(results, *CELL_KEYS),
        "order products": check_reference(cells, products, "Product_ID"),
        "order regions": check_reference(cells, regions, "Region_ID"),
        "order customers": check_reference(cells, customers, "Customer_ID"),
        "forecast products": check_reference(results, products, "Product_ID"),
        "forecast regions": check_reference(results, regions, "Region_ID"),
        "customer regions": check_reference(customers, regions, "Region_ID"),
        "forecast actuals": check_actuals(results, observed),
        "naive baseline": check_baseline(results, observed, "Naive_Forecast", 1),
        "seasonal baseline": check_baseline(results, observed, "Seasonal_Naive_Forecast", 12),
    }
    return (
        broken_order_rules(cells)
        .unionAll(count_broken_rules(results, forecast_rules()))
        .unionAll(count_violations(keyed))
    )


def forecast_gate(results: DataFrame, observed: DataFrame, test: DataFrame) -> DataFrame:
    """Violations of everything that must hold before a forecast fact is handed on.

    Beside its own rules, key and demand lookups, every test cell has one forecast.
    """
    cells = test.select(*CELL_KEYS, F.lit(1).alias("wanted"), F.lit(0).alias("found")).unionAll(
        results.select(*CELL_KEYS, F.lit(0).alias("wanted"), F.lit(1).alias("found"))
    )
    matched = cells.groupBy(*CELL_KEYS).agg(F.sum("wanted").alias("wanted"), F.sum("found").alias("found"))
    keyed = {
        "forecast not empty": check_not_empty(results),
        "forecast cells": check_condition(matched, (F.col("wanted") == 1) & (F.col("found") == 1)),
        "forecast key": check_key(results, *CELL_KEYS),
        "forecast actuals": check_actuals(results, observed),
        "naive baseline": check_baseline(results, observed, "Naive_Forecast", 1),
        "seasonal baseline": check_baseline(results, observed, "Seasonal_Naive_Forecast", 12),
    }
    return count_broken_rules(results, forecast_rules()).unionAll(count_violations(keyed))


def result_gate(
    results: DataFrame,
    detail: DataFrame,
    benchmark: DataFrame,
    views: Mapping[str, DataFrame],
    reconciliation: DataFrame,
    models: Mapping[str, str] = MODEL_COLUMNS,
) -> DataFrame:
    """Violations of everything that must hold before reports are written."""
    return count_violations(
        {
            "detail rows": check_row_ratio(detail, results, len(models)),
            "model metrics": check_metrics(benchmark, results, models),
            "grouped totals": check_grouped_totals(views, benchmark),
            "order reconciliation": check_reconciliation(reconciliation),
        }
    )
