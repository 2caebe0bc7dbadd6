"""Month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.numeric import col


def month_of(value: Column | str) -> Column:
    """First day of the month of a date."""
    return F.trunc(col(value).cast("date"), "MM")


def month_sequence(first: Column, last: Column) -> Column:
    """Array of month starts from first to last, both included."""
    return F.sequence(first, last, F.expr("interval 1 month"))


def quarter_label(value: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(col(value)).cast("string"))


def in_dates(df: DataFrame, first, until=None) -> Column:
    """Orders from the day `first` to before the day `until`; None leaves that side open.

    The bounds are compared with the column as it is stored (`Order_Time`, if the frame
    has it), because a scan can skip data by the stored column but not by a cast of it.
    """
    name = "Order_Time" if "Order_Time" in df.columns else "Order_Date"
    kind, stored, held = df.schema[name].dataType, F.col(name), F.lit(True)
    for bound, compare in ((first, stored.__ge__), (until, stored.__lt__)):
        if bound is not None:
            day = bound if isinstance(bound, Column) else F.lit(bound)
            held = held & compare(day.cast("date").cast(kind))
    return held
