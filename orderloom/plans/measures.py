"""The reusable measure layer.

A measure is a named figure over one of two facts, orders or forecast. `evaluate`
takes measures, grouping columns and filters and returns one row per group. Each fact
is reduced once to the sums that the requested measures need; ratios are formed last.

Orders reach regions through their customer, the forecast has its own region, and
customer filters or groupings do not apply to the forecast.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.constants import (
    COMPLETED, DELAYED, LEGACY_EXCEPTION_TOLERANCE, NAIVE, RANDOM_FOREST, SEASONAL_NAIVE,
)
from orderloom.functions.dates import month_of, quarter_label
from orderloom.functions.numeric import cents, money, ratio, short_money
from orderloom.operators.scratch import materialize

TOP_CUSTOMERS = 10


@dataclass(frozen=True)
class SalesModel:
    """Facts and dimensions. `orders` returns the order fact with the columns named."""

    orders: Callable[..., DataFrame]
    customers: DataFrame
    products: DataFrame
    regions: DataFrame
    forecast: DataFrame | None = None
    primary_model: str = RANDOM_FOREST

    @classmethod
    def of(cls, orders: DataFrame, *args, **kwargs) -> "SalesModel":
        return cls(lambda *columns: orders.select(*columns), *args, **kwargs)


# --- columns available for grouping and filtering -------------------------------

CUSTOMER_COLUMNS = ("Customer_ID", "Customer_Name", "Customer_Type", "Industry")
PRODUCT_COLUMNS = ("Product_ID", "Product_Category", "Product_Line")
REGION_COLUMNS = ("Region_ID", "Region")
ORDER_COLUMNS = ("Order_ID", "Order_Date", "Order_Status")
MODEL_COLUMN = "Model"


def calendar_columns(date: Column) -> dict[str, Column]:
    return {
        "Date": date,
        "Year": F.year(date),
        "Month Number": F.month(date),
        "Month": F.date_format(date, "MMM"),
        "Year Month": F.date_format(date, "yyyy-MM"),
        "Quarter": quarter_label(date),
        "Month Start": month_of(date),
    }


CALENDAR_COLUMNS = ("Date", "Year", "Month Number", "Month", "Year Month", "Quarter", "Month Start")


def calendar(order_dates: DataFrame) -> DataFrame:
    """One row per day from the first to the last order date."""
    bounds = order_dates.agg(F.min("Order_Date").alias("lo"), F.max("Order_Date").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("Date"))
    return days.select(*[c.alias(n) for n, c in calendar_columns(F.col("Date")).items()])


# --- measures -------------------------------------------------------------------


@dataclass(frozen=True)
class Measure:
    """`needs` lists reduced sums (or whole extra aggregates); `value` combines them."""

    needs: tuple[str, ...]
    value: Callable[[], Column]


def _plain(name: str) -> Measure:
    return Measure((name,), lambda: F.col(name))


def _ratio(top: str, bottom: str) -> Measure:
    return Measure((top, bottom), lambda: ratio(top, bottom))


def _root_ratio(top: str, bottom: str) -> Measure:
    return Measure((top, bottom), lambda: F.sqrt(ratio(top, bottom)))


def _change(now: str, before: str) -> Measure:
    def value() -> Column:
        return ratio(F.col(now).cast("double") - F.col(before).cast("double"), before)

    return Measure((now, before), value)


def _improvement(baseline: str) -> Measure:
    def value() -> Column:
        theirs, ours = ratio(baseline, "rows"), ratio("abs_error", "rows")
        return ratio(theirs - ours, theirs)

    return Measure((baseline, "abs_error", "rows"), value)


def _period() -> Column:
    first, last = (F.date_format(c, "MMM yyyy") for c in ("first_month", "last_month"))
    return F.concat(first, F.lit(" - "), last)


def _benchmark(metric: str) -> Measure:
    return Measure(("benchmark",), lambda: F.col(f"benchmark.{metric}"))


ORDER_MEASURES: dict[str, Measure] = {
    "Total Revenue": _plain("revenue"),
    "Total Units Sold": _plain("units"),
    "Ordered Units": _plain("units"),
    "Total Orders": _plain("orders"),
    "Active Customers": _plain("customers"),
    "Average Delivery Days": _ratio("days", "deliveries"),
    "Average Order Value": _ratio("revenue", "orders"),
    "Revenue per Customer": _ratio("revenue", "customers"),
    "Delayed Orders": _plain("late_orders"),
    "Delayed Revenue": _plain("late_revenue"),
    "On-Time Orders": _plain("done_orders"),
    "On-Time Units": _plain("done_units"),
    "Delayed Order Rate %": _ratio("late_orders", "orders"),
    "On-Time Order Rate %": _ratio("done_orders", "orders"),
    "On-Time Unit Rate %": _ratio("done_units", "units"),
    "Revenue Contribution %": _ratio("revenue", "all_customer_revenue"),
    "Revenue Previous Year": _plain("previous_revenue"),
    "Revenue YoY Growth %": _change("revenue", "previous_revenue"),
    "Top 10 Customer Revenue": _plain("top_revenue"),
    "Top 10 Customer Revenue %": _ratio("top_revenue", "revenue"),
    "Revenue Display": Measure(("revenue",), lambda: short_money("revenue")),
    "Sum of Delivery Days": _plain("days"),
}

FORECAST_MEASURES: dict[str, Measure] = {
    "Total Actual Demand": _plain("actual"),
    "Total Forecast Demand": _plain("forecast"),
    "Forecast Error": _plain("error"),
    "Forecast Observations": _plain("rows"),
    "Absolute Forecast Error": _plain("abs_error"),
    "Absolute Forecast Error Impact": _plain("abs_error"),
    "WAPE %": _ratio("abs_error", "actual"),
    "Forecast Accuracy": Measure(
        ("abs_error", "actual"), lambda: F.lit(1.0) - ratio("abs_error", "actual")
    ),
    "Forecast Bias %": _ratio("error", "actual"),
    "Mean Forecast Bias": _ratio("error", "rows"),
    "Forecast MAE": _ratio("abs_error", "rows"),
    "Forecast RMSE": _root_ratio("sq_error", "rows"),
    "Overforecast Observations": _plain("over"),
    "Underforecast Observations": _plain("under"),
    "Planning Exceptions": _plain("exceptions"),
    "Forecast Evaluation Period": Measure(("first_month", "last_month"), _period),
    "Naive MAE": _ratio("naive_abs", "rows"),
    "Naive RMSE": _root_ratio("naive_sq", "rows"),
    "Naive WAPE %": _ratio("naive_abs", "actual"),
    "Seasonal Naive MAE": _ratio("seasonal_abs", "rows"),
    "Seasonal Naive RMSE": _root_ratio("seasonal_sq", "rows"),
    "Seasonal Naive WAPE %": _ratio("seasonal_abs", "actual"),
    "Benchmark MAE": _benchmark("mae"),
    "Benchmark RMSE": _benchmark("rmse"),
    "Benchmark WAPE %": _benchmark("wape"),
    "MAE Improvement vs Naive %": _improvement("naive_abs"),
    "MAE Improvement vs Seasonal %": _improvement("seasonal_abs"),
}

MEASURES = {**ORDER_MEASURES, **FORECAST_MEASURES}
Filters = Mapping[str, Sequence]


def measure(name: str) -> Measure:
    if name not in MEASURES:
        raise KeyError(f"Unknown measure: {name}")
    return MEASURES[name]


def _matching(df: DataFrame, filters: Filters, columns: Sequence[str]) -> DataFrame:
    for name, values in filters.items():
        if name in columns:
            df = df.where(F.col(name).isin(list(values)))
    return df


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join two aggregates on group keys, NULL groups matching; without keys both have one row."""
    if not keys:
        # one row each: a single scalar struct carries all of the right side's columns
        right_row = right.select(F.struct(*right.columns)).scalar()
        return left.withColumn("_right", right_row).select(*left.columns, "_right.*")
    rest = [c for c in right.columns if c not in keys]
    other = right.select(*[F.col(f"`{k}`").alias(f"_{k}") for k in keys], *rest)
    joined = left.join(other, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_{k}`")) for k in keys], how)
    merged = {k: F.coalesce(F.col(f"`{k}`"), F.col(f"`_{k}`")) for k in keys}
    return joined.withColumns(merged).drop(*[f"_{k}" for k in keys])


# --- orders ---------------------------------------------------------------------

_SUMS = ("revenue", "units", "days", "deliveries", "late_revenue", "done_units", "last_date")
_ORDER_COUNTS = ("orders", "late_orders", "done_orders")
_SOURCE = {
    "revenue": ("Revenue",), "units": ("Quantity",), "days": ("Delivery_Days",),
    "deliveries": ("Delivery_Days",), "late_revenue": ("Revenue", "Order_Status"),
    "done_units": ("Quantity", "Order_Status"), "orders": ("Order_ID",),
    "late_orders": ("Order_ID", "Order_Status"), "done_orders": ("Order_ID", "Order_Status"),
    "customers": ("Customer_ID",), "last_date": ("Order_Date",),
}


def _fold(part: str) -> Column:
    """Combine finer rows of a part into coarser ones."""
    return (F.max(part) if part == "last_date" else F.sum(part)).alias(part)


def _group(df: DataFrame, keys: Sequence[str]):
    return df.groupBy(*[F.col(f"`{k}`") for k in keys])


def _line_sums(parts: Sequence[str]) -> list[Column]:
    done = F.col("Order_Status") == COMPLETED if {"done_units"} & set(parts) else None
    late = F.col("Order_Status") == DELAYED if {"late_revenue"} & set(parts) else None
    made = {
        "revenue": lambda: F.sum(cents("Revenue")),
        "units": lambda: F.sum("Quantity"),
        "days": lambda: F.sum("Delivery_Days"),
        "deliveries": lambda: F.count("Delivery_Days"),
        "late_revenue": lambda: F.sum(F.when(late, cents("Revenue"))),
        "done_units": lambda: F.sum(F.when(done, F.col("Quantity"))),
        "last_date": lambda: F.max("Order_Date"),
    }
    return [made[p]().alias(p) for p in parts if p in made]


def _order_totals(
    model: SalesModel,
    parts: Sequence[str],
    keys: Sequence[str],
    filters: Filters,
    shift_months: int = 0,
    last_date: Column | None = None,
) -> DataFrame:
    """Reduce the order fact: first to orders, then to customers, then to the groups.

    An order has one customer and a customer one region, so counts made on a finer
    level add up on the coarser one, and customer attributes are joined to customers,
    not to order lines. Levels that no part and no key asks for are left out.
    """
    named = set(keys) | set(filters)
    of_customer = [c for c in named if c in CUSTOMER_COLUMNS or c in REGION_COLUMNS]
    of_product = [c for c in named if c in PRODUCT_COLUMNS]
    of_calendar = [c for c in named if c in CALENDAR_COLUMNS]
    of_order = [c for c in named if c in ORDER_COLUMNS]
    by_customer = bool(of_customer) or "customers" in parts

    columns = {c for p in parts for c in _SOURCE[p]} | set(of_order)
    columns |= {"Customer_ID"} if by_customer else set()
    columns |= {"Product_ID"} if of_product else set()
    columns |= {"Order_Date"} if of_calendar or shift_months else set()
    fact = model.orders(*sorted(columns))

    if shift_months:
        if last_date is None:
            last_date = model.orders("Order_Date").agg(F.max("Order_Date")).scalar()
        fact = fact.withColumn("Order_Date", F.add_months("Order_Date", shift_months))
        fact = fact.where(F.col("Order_Date") <= last_date)
    if of_calendar:
        days = calendar_columns(F.col("Order_Date"))
        fact = fact.withColumns({c: days[c] for c in of_calendar})
    fact = _matching(fact, filters, [*CALENDAR_COLUMNS, *ORDER_COLUMNS])
    if set(of_product) - {"Product_ID"}:
        products = _matching(model.products, filters, PRODUCT_COLUMNS)
        fact = fact.join(products, "Product_ID", "inner" if set(filters) & set(of_product) else "left")
    else:
        fact = _matching(fact, filters, PRODUCT_COLUMNS)

    line_keys = [k for k in keys if k in (*CALENDAR_COLUMNS, *PRODUCT_COLUMNS, *ORDER_COLUMNS)]
    sums = [p for p in parts if p in _SUMS]
    counts = [p for p in parts if p in _ORDER_COUNTS]
    level = [*line_keys, *(["Customer_ID"] if by_customer else [])]
    level = list(dict.fromkeys(level))

    if counts:
        status = F.col("Order_Status")
        flags = {
            "late_orders": lambda: F.max(status == DELAYED),
            "done_orders": lambda: F.max(status == COMPLETED),
        }
        order_key = [] if "Order_ID" in level else ["Order_ID"]
        per_order = _group(fact, [*level, *order_key]).agg(
            F.count("Order_ID").alias("_lines"),
            *_line_sums(sums),
            *[flags[c]().alias(f"_{c}") for c in counts if c in flags],
        )
        known = F.col("_lines") > 0
        tally = {
            "orders": F.count_if(known),
            "late_orders": F.count_if(F.col("_late_orders") & known) if "late_orders" in counts else None,
            "done_orders": F.count_if(F.col("_done_orders") & known) if "done_orders" in counts else None,
        }
        source, folded = per_order, [_fold(p) for p in sums]
        folded += [tally[c].alias(c) for c in counts]
    else:
        source, folded = fact, _line_sums(sums) or [F.count(F.lit(1)).alias("_rows")]

    # money stays in whole cents until the last level
    amounts = {p: money(p) for p in sums if p in ("revenue", "late_revenue")}
    if not by_customer:
        return _group(source, level).agg(*folded).withColumns(amounts)

    per_customer = _group(source, level).agg(*folded)
    if set(of_customer) - {"Customer_ID"}:
        buyers = model.customers
        if set(of_customer) & {"Region"}:
            buyers = buyers.join(model.regions, "Region_ID", "left")
        wanted = list(dict.fromkeys(["Customer_ID", *of_customer]))
        per_customer = per_customer.join(buyers.select(*wanted), "Customer_ID", "left")
    per_customer = _matching(per_customer, filters, [*CUSTOMER_COLUMNS, *REGION_COLUMNS])
    if {"Customer_ID", "Order_ID"} & set(keys):
        # already one row per group
        known = F.col("Customer_ID").isNotNull().cast("bigint").alias("customers")
        columns = [F.col(f"`{k}`") for k in keys] + [known] * ("customers" in parts)
        return per_customer.select(*columns, *sums, *counts).withColumns(amounts)
    totals = [_fold(p) for p in [*sums, *counts]]
    if "customers" in parts:
        totals.append(F.count("Customer_ID").alias("customers"))
    return _group(per_customer, keys).agg(*totals or [F.count(F.lit(1)).alias("_rows")]).withColumns(amounts)


def _top_customer_revenue(per_customer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Revenue of each group's customers that are among the largest, ties at the cut included.

    Customers compete within the other group columns: a group of a single customer has a
    value only if that customer is a leader. Spark keeps only the leading rows of every
    task before the ranks are shuffled.
    """
    contest = [F.col(f"`{k}`") for k in keys if k not in ("Customer_ID", "Customer_Name")]
    leading = Window.partitionBy(*contest).orderBy(F.desc_nulls_last("revenue"))
    placed = per_customer.withColumn("_place", F.rank().over(leading))
    return _group(placed.where(F.col("_place") <= TOP_CUSTOMERS), keys).agg(
        F.sum("revenue").alias("top_revenue")
    )


def _orders_frame(
    model: SalesModel, needs: Sequence[str], keys: Sequence[str], filters: Filters
) -> DataFrame:
    """All parts of the order measures, with as few passes over the fact as they allow."""
    parts = [p for p in _SOURCE if p in needs]
    if not parts or {"all_customer_revenue", "previous_revenue", "top_revenue"} & set(needs):
        parts = list(dict.fromkeys([*parts, "revenue"]))
    wants_previous, last_date, per_customer = "previous_revenue" in needs, None, None
    if "top_revenue" in needs:
        # One pass to customers within groups, stored; totals and leaders are read off it.
        extra = ["last_date"] if wants_previous and not filters else []
        finer = list(dict.fromkeys([*keys, "Customer_ID"]))
        per_customer = materialize(
            _order_totals(model, [*parts, *extra], finer, filters), "customer-measures"
        )
        frame = _group(per_customer, keys).agg(*[_fold(p) for p in parts])
        if extra:
            last_date = per_customer.agg(F.max("last_date")).scalar()
    else:
        frame = _order_totals(model, parts, keys, filters)

    if "all_customer_revenue" in needs:
        # every customer: neither customer nor (customer-reached) region filters apply
        dropped = {*CUSTOMER_COLUMNS, *REGION_COLUMNS}
        kept = [k for k in keys if k not in dropped]
        rest = {k: v for k, v in filters.items() if k not in dropped}
        if per_customer is not None and len(rest) == len(filters):
            total = _group(per_customer, kept).agg(_fold("revenue"))
        else:
            total = _order_totals(model, ["revenue"], kept, rest)
        total = total.withColumnRenamed("revenue", "all_customer_revenue")
        if kept:
            frame = _join_groups(frame, total, kept, "left")
        else:
            frame = frame.withColumn("all_customer_revenue", total.select("all_customer_revenue").scalar())
    if wants_previous:
        before = _order_totals(model, ["revenue"], keys, filters, shift_months=12, last_date=last_date)
        frame = _join_groups(
            frame, before.withColumnRenamed("revenue", "previous_revenue"), keys, "full"
        )
    if per_customer is not None:
        frame = _join_groups(frame, _top_customer_revenue(per_customer, keys), keys, "left")
    return frame


# --- forecast -------------------------------------------------------------------


def _forecast_frame(
    model: SalesModel,
    needs: Sequence[str],
    keys: Sequence[str],
    filters: Filters,
    every_sum: bool = False,
) -> DataFrame:
    """Reduce the forecast fact; customer and order columns do not reach it."""
    if model.forecast is None:
        raise ValueError("This model has no forecast fact.")
    reachable = (*CALENDAR_COLUMNS, *PRODUCT_COLUMNS, *REGION_COLUMNS, "forecast_month")
    named = [c for c in {*keys, *filters} if c in reachable]
    days = calendar_columns(F.col("forecast_month"))
    rows = model.forecast.withColumnRenamed("Month", "forecast_month")
    rows = rows.withColumns({c: days[c] for c in named if c in CALENDAR_COLUMNS})
    if {"Product_Category", "Product_Line"} & set(named):
        rows = rows.join(model.products, "Product_ID", "left")
    if "Region" in named:
        rows = rows.join(model.regions, "Region_ID", "left")
    rows = _matching(rows, filters, reachable)

    actual, own = F.col("Actual_Demand"), F.col("Forecast_Demand")
    error = own - actual
    naive, seasonal = (F.col(c) - actual for c in ("Naive_Forecast", "Seasonal_Naive_Forecast"))
    relative = ratio(error, actual)
    sums = {
        "rows": F.count(F.lit(1)),
        "actual": F.sum(actual),
        "forecast": F.sum(own),
        "error": F.sum(error),
        "abs_error": F.sum(F.abs(error)),
        "sq_error": F.sum(error * error),
        "over": F.count_if(own > actual),
        "under": F.count_if(own < actual),
        "exceptions": F.count_if(F.abs(relative) >= LEGACY_EXCEPTION_TOLERANCE),
        "first_month": F.min("forecast_month"),
        "last_month": F.max("forecast_month"),
        "naive_abs": F.sum(F.abs(naive)),
        "naive_sq": F.sum(naive * naive),
        "seasonal_abs": F.sum(F.abs(seasonal)),
        "seasonal_sq": F.sum(seasonal * seasonal),
    }
    picked = [n for n in sums if every_sum or n in needs]
    group = [k for k in keys if k in reachable]
    return _group(rows, group).agg(*[sums[n].alias(n) for n in picked or ["rows"]])


def model_selector(primary_model: str = RANDOM_FOREST) -> list[tuple[str, int]]:
    """The comparison rows in display order; no relation to any fact."""
    return [(primary_model, 1), (NAIVE, 2), (SEASONAL_NAIVE, 3)]


def _with_models(frame: DataFrame, model: SalesModel, keys: Sequence[str], filters: Filters) -> DataFrame:
    """Repeat the groups per selected model, with that model's benchmark figures.

    Without a grouping by model the benchmark is blank unless one model is selected.
    """
    prefixes = {1: ("abs_error", "sq_error"), 2: ("naive_abs", "naive_sq"),
                3: ("seasonal_abs", "seasonal_sq")}
    selected = filters.get(MODEL_COLUMN)
    entries = []
    for label, sort in model_selector(model.primary_model):
        if selected is not None and label not in selected:
            continue
        absolute, squared = prefixes[sort]
        metrics = F.struct(
            ratio(absolute, "rows").alias("mae"),
            F.sqrt(ratio(squared, "rows")).alias("rmse"),
            ratio(absolute, "actual").alias("wape"),
        )
        entries.append(
            F.struct(F.lit(label).alias(MODEL_COLUMN), F.lit(sort).alias("Sort"), metrics.alias("benchmark"))
        )
    if MODEL_COLUMN in keys:
        return frame.select("*", F.inline(F.array(*entries)))
    if len(entries) == 1:
        return frame.withColumn("benchmark", entries[0].getField("benchmark"))
    blank = F.lit(None).cast("struct<mae:double,rmse:double,wape:double>")
    return frame.withColumn("benchmark", blank)


# --- evaluation -----------------------------------------------------------------


def evaluate(
    model: SalesModel,
    measures: Sequence[str],
    group_by: Sequence[str] = (),
    filters: Filters | None = None,
) -> DataFrame:
    """One row per group with the requested measures.

    Orders and forecast are aggregated apart and joined on the keys both have; a group
    present in only one of them stays, with NULL for the other's measures.
    """
    filters, keys = dict(filters or {}), list(group_by)
    known = {*CALENDAR_COLUMNS, *ORDER_COLUMNS, *CUSTOMER_COLUMNS, *PRODUCT_COLUMNS, *REGION_COLUMNS,
             "forecast_month", MODEL_COLUMN}
    if unknown := sorted({*filters, *keys} - known):
        raise KeyError(f"Unknown columns: {unknown}")
    chosen = {name: measure(name) for name in measures}
    on_orders = [m for n, m in chosen.items() if n in ORDER_MEASURES]
    on_forecast = [m for n, m in chosen.items() if n in FORECAST_MEASURES]

    groups = [k for k in keys if k != MODEL_COLUMN]
    wants_models = MODEL_COLUMN in keys or any("benchmark" in m.needs for m in on_forecast)
    frames = []
    if on_orders:
        needs = list(dict.fromkeys(n for m in on_orders for n in m.needs))
        frames.append(_orders_frame(model, needs, groups, filters))
    if on_forecast or wants_models:
        needs = list(dict.fromkeys(n for m in on_forecast for n in m.needs))
        frames.append(_forecast_frame(model, needs, groups, filters, wants_models))

    frame = frames[0]
    if len(frames) == 2:
        right = frames[1]
        shared = [k for k in groups if k in right.columns]  # orders have every group column
        frame = _join_groups(frame, right, shared, "full")
    if wants_models:
        frame = _with_models(frame, model, keys, filters)
    return frame.select(*[F.col(f"`{k}`") for k in keys], *[m.value().alias(n) for n, m in chosen.items()])
