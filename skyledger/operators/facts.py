"""Fact building."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.dates import date_key
from skyledger.functions.numeric import weighted_avg
from skyledger.operators.joins import compared_keys, fits_broadcast, hot_keys_of, keyed_join


@dataclass(frozen=True)
class Lookup:
    """Replace ``business_key`` of a fact by ``surrogate`` of a dimension.

    ``unique`` says that the fact has one row per business key, so that no key can be hot.
    """

    dimension: DataFrame
    business_key: str
    surrogate: str
    dimension_key: str | None = None
    unique: bool = False


def lookup_keys(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Add surrogate keys. An unmatched or null business key gives a null key and the row stays.

    The business key must be unique in its dimension; check with duplicate_keys.
    """
    members = [
        lookup.dimension.select(F.col(lookup.dimension_key or lookup.business_key).alias(lookup.business_key), lookup.surrogate)
        for lookup in lookups
    ]
    # A lookup adds columns and keeps the rows, so all keys are measured once, before the joins.
    large = {
        lookup.business_key: compared_keys(fact, keys, [lookup.business_key])
        for lookup, keys in zip(lookups, members, strict=True)
        if not lookup.unique and lookup.business_key in fact.columns and not fits_broadcast(keys)
    }
    hot = hot_keys_of(fact, large) if large else {}
    measured = fact
    for lookup, keys in zip(lookups, members, strict=True):
        if lookup.unique:
            # Unsorted on both sides: a dimension has one row per key, so partitions of them are even and small.
            fact = fact.join(keys if fits_broadcast(keys) else keys.hint("shuffle_hash"), lookup.business_key, "left")
        else:
            # A key that an earlier lookup gave is measured on what that made.
            source = measured if lookup.business_key in measured.columns else None
            fact = keyed_join(fact, keys, [lookup.business_key], "left", source, hot.get(lookup.business_key))
    return fact


def map_unknown_key(fact: DataFrame, key: str, unknown: str) -> DataFrame:
    """Point unmatched rows to the unknown member."""
    return fact.withColumn(key, F.coalesce(F.col(key), F.lit(unknown)))


def with_date_key(fact: DataFrame, source: str, name: str = "date_key") -> DataFrame:
    """Add the yyyyMMdd key of a date or timestamp column."""
    return fact.withColumn(name, date_key(F.col(source)))


def aggregate_to_grain(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    weighted: Mapping[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Collapse observations to the grain: sums, and means weighted by another column.

    ``weighted`` maps an output column to (value, weight).
    """
    means = [weighted_avg(value, weight).alias(name) for name, (value, weight) in (weighted or {}).items()]
    return df.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in sums], *means)


def borrow_parent_date(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_time: str,
    name: str,
    parent_key: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Give a child row the date of its parent, and the parent's columns in ``carry``.

    A child without a parent keeps nulls.
    """
    dates = parent.select(F.col(parent_key or key).alias(key), F.to_date(parent_time).alias(name), *carry)
    return keyed_join(child, dates, [key], "left")
