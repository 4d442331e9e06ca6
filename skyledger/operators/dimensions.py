"""Dimension building."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.dates import calendar_columns
from skyledger.operators.ordering import global_row_number


def union_dates(sources: Sequence[tuple[DataFrame, str]], name: str = "date") -> DataFrame:
    """The dates of several tables under each other, without nulls; duplicates stay."""
    dates = [df.select(F.to_date(column).alias(name)) for df, column in sources]
    return reduce(DataFrame.unionByName, dates).filter(F.col(name).isNotNull())


def date_spine(dates: DataFrame, column: str = "date") -> DataFrame:
    """One row per day from the first to the last date, in one plan."""
    bounds = dates.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))


def calendar_attributes(df: DataFrame, column: str = "date") -> DataFrame:
    """The date dimension's attributes of a column of days."""
    return df.select(*[value.alias(name) for name, value in calendar_columns(F.col(column)).items()])


def format_key(number: Column, prefix: str, width: int = 4) -> Column:
    """Prefix and zero-padded number; a number longer than the width keeps all its digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def surrogate_key(
    df: DataFrame, order: Sequence[str], prefix: str, name: str, width: int = 4
) -> DataFrame:
    """Number the rows in a global order and add the formatted key as the first column."""
    numbered = global_row_number(df, [F.col(column).asc() for column in order], "__number")
    return numbered.select(format_key(F.col("__number"), prefix, width).alias(name), *df.columns)


def unknown_member(dimension: DataFrame, row: tuple) -> DataFrame:
    """Add the member that unmatched facts point to."""
    return dimension.sparkSession.createDataFrame([row], dimension.schema).unionByName(dimension)


def distinct_dimension(df: DataFrame, column: str) -> DataFrame:
    """The distinct present values of a column."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct()


def project_dimension(df: DataFrame, key: str, business_key: str, attributes: Sequence[str]) -> DataFrame:
    """Key, business key and descriptive attributes."""
    return df.select(key, business_key, *attributes)
