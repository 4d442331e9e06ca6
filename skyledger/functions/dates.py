"""Date keys, calendar attributes and reporting periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(column: Column) -> Column:
    """yyyyMMdd as an int from a date or timestamp; a null date gives a null key."""
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def calendar_columns(date: Column) -> dict[str, Column]:
    """The attributes of the date dimension. Weeks are ISO weeks, the weekend is Saturday and Sunday."""
    return {
        "date_key": date_key(date),
        "date": date,
        "day": F.dayofmonth(date),
        "day_name": F.date_format(date, "EEEE"),
        "week_of_year": F.weekofyear(date),
        "month": F.month(date),
        "month_name": F.date_format(date, "MMMM"),
        "quarter": F.quarter(date),
        "year": F.year(date),
        "is_weekend": F.dayofweek(date).isin(1, 7),
    }


# The kinds of reporting period.
PERIOD_KINDS = ("year", "month", "first_week", "last_week", "end_of_month")


def period_start(kind: Column, year: Column, month: Column) -> Column:
    """First day of a period; null for an unknown kind."""
    first = F.make_date(year, month, F.lit(1))
    return (
        F.when(kind == "year", F.make_date(year, F.lit(1), F.lit(1)))
        .when(kind.isin("month", "first_week"), first)
        .when(kind.isin("last_week", "end_of_month"), F.date_sub(F.last_day(first), 6))
    )


def period_end(kind: Column, year: Column, month: Column) -> Column:
    """Last day of a period, inclusive; null for an unknown kind."""
    first = F.make_date(year, month, F.lit(1))
    return (
        F.when(kind == "year", F.make_date(year, F.lit(12), F.lit(31)))
        .when(kind == "first_week", F.date_add(first, 6))
        .when(kind.isin("month", "last_week", "end_of_month"), F.last_day(first))
    )


def make_period(label: Column, kind: Column, year: Column, month: Column) -> Column:
    """struct<label, start_date, end_date>, both ends inclusive."""
    return F.struct(
        label.alias("label"),
        period_start(kind, year, month).alias("start_date"),
        period_end(kind, year, month).alias("end_date"),
    )
