"""Ratios and counts with the blank rules of the KPI model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div(numerator: Column, denominator: Column) -> Column:
    """Ratio that is null where the divisor is null or 0."""
    return F.try_divide(numerator, denominator)


def div0(numerator: Column, denominator: Column) -> Column:
    """Ratio with alternate 0: a null or 0 divisor gives 0, a null numerator stays null."""
    blank = denominator.isNull() | (denominator == 0)
    return F.when(blank, F.lit(0.0)).otherwise(F.try_divide(numerator, denominator))


def blank_if_zero(count: Column) -> Column:
    """A count over no rows is blank, not 0."""
    return F.nullif(count, F.lit(0))


def weighted_avg(value: Column, weight: Column) -> Column:
    """sum(value * weight) / sum(weight).

    A null in either operand drops that product, while a null value with a present weight still
    counts in the divisor.
    """
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def whole_number(text: Column) -> Column:
    """Bigint from text that may carry decimals ('167.0' is 167); bad text is null.

    The way leads over a decimal, so every bigint keeps all its digits.
    """
    return text.try_cast("decimal(38,10)").try_cast("bigint")
