"""Calendar expressions and date rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def age_years(born: Column, at: Column, year_days: str) -> Column:
    """Years between two dates for a given length of the year, as an exact decimal."""
    return F.datediff(at, born).cast("decimal(18,6)") / F.lit(year_days).cast("decimal(10,4)")


def outside(day: Column, start: Column, end: Column) -> Column:
    return (day < start) | (day > end)


def inside(day: Column, start: Column, end: Column) -> Column:
    return (day >= start) & (day <= end)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def midnight(day: Column) -> Column:
    """A date as the first instant of that day, for comparison with timestamps."""
    return day.cast("timestamp")


def epoch_day(day: Column) -> Column:
    return F.datediff(F.to_date(day), F.lit("1970-01-01").cast("date"))


def calendar(span: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day of a one-row span of dates."""
    day = F.col("date_key")
    weekday = F.weekday(day) + 1
    return span.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("date_key")).select(
        "date_key",
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("smallint").alias("day"),
        weekday.cast("smallint").alias("day_of_week"),
        weekday.isin(6, 7).alias("is_weekend"),
    )
