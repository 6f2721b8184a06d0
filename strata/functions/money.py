"""Exact arithmetic on money and shares."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

def cents(amount: Column) -> Column:
    """Two-decimal money as a whole number of cents."""
    return F.round(amount.cast("decimal(38,4)") * 100, 0).cast("bigint")


def _whole(number: Column, scale: int) -> Column:
    """A number with at most ``scale`` decimals as a whole number of 10^-scale."""
    return (number.cast(f"decimal(38,{scale})") * F.lit(Decimal(10**scale))).cast("decimal(38,0)")


def ratio(numerator: Column, denominator: Column, digits: int, scale: int = 10, times: int = 1) -> Column:
    """Quotient, ``times`` that many, rounded once, half away from zero; NULL where the denominator is 0.

    The operands are decimals or whole numbers with at most ``scale`` decimals. They are divided as whole numbers with a remainder, so no digit is cut off
    and no intermediate quotient is rounded: 28 - digits places are left before the point of the denominator, 9 * 10^18 for the quotient.
    """
    n, d = _whole(numerator, scale) * F.lit(Decimal(times)), _whole(denominator, scale)
    size, by = F.abs(n).cast("decimal(38,0)"), F.nullif(F.abs(d), F.lit(Decimal(0))).cast("decimal(38,0)")
    left = F.call_function("mod", size, by).cast("decimal(38,0)")
    rest = (left * F.lit(Decimal(2 * 10**digits)) + by).cast("decimal(38,0)")
    tail = F.call_function("div", rest, (by * F.lit(Decimal(2))).cast("decimal(38,0)"))
    whole = ((size - left).cast("decimal(38,0)") / by).cast("decimal(19,0)")  # divides evenly; a larger one raises
    value = whole + tail.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-digits))
    value = value.cast(f"decimal({19 + digits},{digits})")
    return F.when((n < 0) != (d < 0), -value).otherwise(value)


def percent(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    """Share in percent; NULL where the denominator is 0."""
    return ratio(numerator, denominator, digits, times=100)


def pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Share in percent as the audits print it: 0 where the denominator is 0."""
    return F.coalesce(percent(numerator, denominator, digits), F.lit(0).cast(f"decimal(38,{digits})"))


def mean(amount: Column, digits: int) -> Column:
    """Exact rounded mean of a decimal column, from its sum and count."""
    return ratio(F.sum(amount), F.count(amount), digits)


def within(left: Column, right: Column, tolerance: str = "0.01") -> Column:
    return F.abs(left - right) <= F.lit(tolerance).cast("decimal(12,4)")


def beyond(left: Column, right: Column, tolerance: str = "0.01") -> Column:
    return F.abs(left - right) > F.lit(tolerance).cast("decimal(12,4)")


def payment_band(paid: Column, due: Column, tolerance: str = "0.01") -> Column:
    """unpaid without payments, else over / under the due amount by more than the tolerance, else full."""
    slack = F.lit(tolerance).cast("decimal(12,4)")
    return (
        F.when(paid.isNull(), "unpaid")
        .when(paid - due > slack, "overpaid")
        .when(due - paid > slack, "partial")
        .otherwise("full")
    )
