"""Exact sums, null-on-zero ratios and rounding shared by all reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

MONEY = "decimal(22,2)"
MOST_CENTS = 9e18


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cents(value: Column | str) -> Column:
    """Money as whole cents, halves away from zero.

    Integer sums are exact in any order and stay in the aggregate's fixed-width buffer;
    parsing every double into a decimal and adding decimals costs several times as much.
    NaN, infinite and too large amounts raise, as they would otherwise count as something else.
    """
    amount = col(value).cast("double") * 100
    # NaN compares greater than every number
    refused = F.raise_error(F.lit("an amount of money is not a number or too large")).cast("bigint")
    rounded = F.when(amount < 0, -F.floor(0.5 - amount)).otherwise(F.floor(amount + 0.5))
    return F.when(F.abs(amount) >= MOST_CENTS, refused).otherwise(rounded)


def money(total_cents: Column | str) -> Column:
    """Whole cents back to an exact two-decimal amount."""
    return (col(total_cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def money_sum(value: Column | str) -> Column:
    """Exact sum of money, the same for every order of rows."""
    return money(F.sum(cents(value)))


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Double division that yields NULL for a zero denominator."""
    return F.try_divide(col(top).cast("double"), col(bottom).cast("double"))


def pct(top: Column | str, bottom: Column | str) -> Column:
    return F.try_divide(F.lit(100.0) * col(top).cast("double"), col(bottom).cast("double"))


def round2(value: Column | str) -> Column:
    """Two decimals, halves away from zero on the scaled double."""
    number = col(value).cast("double")
    return F.signum(number) * F.floor(F.abs(number) * 100 + 0.5) / 100


def is_finite(value: Column | str) -> Column:
    number = col(value).cast("double")
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))


def close_to(left: Column | str, right: Column | str, rtol: float = 1e-7, atol: float = 0.0) -> Column:
    """True where both sides agree within tolerance, or are both NULL."""
    a, b = col(left).cast("double"), col(right).cast("double")
    near = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    return F.coalesce(near, a.isNull() & b.isNull())


def short_money(value: Column | str) -> Column:
    """Text such as 1.25M: billions, millions and thousands with two decimals."""
    amount = col(value).cast("decimal(38,2)")
    cents = (amount * 100).cast("bigint")

    def scaled(unit: int, suffix: str) -> Column:
        hundredths = F.call_function("div", cents + unit // 2, F.lit(unit))
        whole = F.call_function("div", hundredths, F.lit(100)).cast("string")
        rest = F.lpad((hundredths % 100).cast("string"), 2, "0")
        return F.concat(whole, F.lit("."), rest, F.lit(suffix))

    return (
        F.when(amount >= 1_000_000_000, scaled(1_000_000_000, "B"))
        .when(amount >= 1_000_000, scaled(1_000_000, "M"))
        .when(amount >= 1_000, scaled(1_000, "K"))
        .when(amount.isNotNull(), F.round(amount, 0).cast("bigint").cast("string"))
    )
