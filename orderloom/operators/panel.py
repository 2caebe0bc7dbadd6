"""The complete monthly demand panel: every month for every product and region."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from orderloom.constants import CELL_KEYS, SERIES_KEYS
from orderloom.functions.dates import month_of, month_sequence
from orderloom.operators.scratch import materialize

ORDER_COLUMNS = ("Order_Date", "Product_ID", "Region_ID", "Quantity")


def monthly_observed(orders: DataFrame) -> DataFrame:
    """Units ordered by month, product and region; delayed orders are demand too."""
    keyed = orders.select(month_of("Order_Date").alias("Month"), *SERIES_KEYS, "Quantity")
    return (
        keyed.dropna(subset=CELL_KEYS)
        .groupBy(*CELL_KEYS)
        .agg(F.sum("Quantity").alias("Actual_Demand"))
    )


def month_spine(observed: DataFrame) -> DataFrame:
    """All month starts from the first to the last observed month."""
    bounds = observed.agg(F.min("Month").alias("first"), F.max("Month").alias("last"))
    return bounds.select(F.explode(month_sequence(F.col("first"), F.col("last"))).alias("Month"))


def every_pair(left: DataFrame, right: DataFrame) -> DataFrame:
    """All pairs of two dimensions' rows: a grid is their product by definition.

    Both sides are dealt into blocks, and each side is copied once for every block of the
    other, so the pairing is an ordinary join over pairs of blocks. There are about as
    many of these as the session has shuffle partitions, whichever side is the larger;
    that is the number that a cluster sets by the size of its data.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = math.isqrt(max(1, parts - 1)) + 1

    def dealt(df: DataFrame, own: str, copy: str) -> DataFrame:
        block = F.pmod(F.hash(*df.columns), F.lit(blocks))
        return df.withColumn(own, block).withColumn(copy, F.explode(F.array(*[F.lit(b) for b in range(blocks)])))

    return dealt(left, "_l", "_r").join(dealt(right, "_r", "_l"), ["_l", "_r"]).drop("_l", "_r")


def complete_panel(observed: DataFrame) -> DataFrame:
    """Zero-filled panel from observed cells (read several times: pass a stored frame).

    A series is one row holding its observed months as a map until the very last step,
    where it expands along the month spine. The large frame, the full grid, therefore
    appears already partitioned by series, as the lag windows need it, and is neither
    joined nor shuffled. A map has at most as many entries as there are months.
    """
    months = observed.agg(month_sequence(F.min("Month"), F.max("Month"))).scalar()
    pairs = every_pair(observed.select("Product_ID").distinct(), observed.select("Region_ID").distinct())
    history = observed.groupBy(*SERIES_KEYS).agg(
        F.map_from_entries(F.collect_list(F.struct("Month", "Actual_Demand"))).alias("history")
    )
    series = pairs.join(history, SERIES_KEYS, "left").withColumn("months", months)
    demand = F.coalesce(F.try_element_at("history", F.col("Month")), F.lit(0)).cast("bigint")
    return series.select(*SERIES_KEYS, "history", F.explode_outer("months").alias("Month")).select(
        *CELL_KEYS, demand.alias("Actual_Demand")
    )


def calendar_features(panel: DataFrame, first_year=None) -> DataFrame:
    """Year, month number, quarter and the running month index counted from the first year."""
    start = panel.agg(F.year(F.min("Month"))).scalar() if first_year is None else first_year
    year, number = F.year("Month"), F.month("Month")
    return panel.withColumns(
        {
            "Year": year,
            "Month_Number": number,
            "Quarter": F.quarter("Month"),
            "Time_Index": (year - start) * 12 + number,
        }
    )


def monthly_panel(orders: DataFrame) -> DataFrame:
    """Orders to the complete panel; the order fact is scanned once."""
    observed = materialize(monthly_observed(orders), "monthly-observed")
    first_year = observed.agg(F.year(F.min("Month"))).scalar()
    return calendar_features(complete_panel(observed), first_year)
