"""The star model: facts, dimensions, relationships, and the filters that travel along them."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.joins import keyed_join
from skyledger.sources.monthly import MONTH, month_of


@dataclass(frozen=True)
class Relationship:
    """Many-to-one: ``fact.key`` points to ``dimension.key``."""

    fact: str
    key: str
    dimension: str


@dataclass(frozen=True)
class Filter:
    """A predicate on the columns of one table, a dimension or a fact.

    ``key_range`` repeats a date filter as bounds of the date key, so that it also reaches the
    scan of the facts.
    """

    table: str
    predicate: Column
    key_range: tuple[int, int] | None = None


def filter_date_between(table: str, column: str, start: date, end: date) -> Filter:
    """Start inclusive, end exclusive."""
    column_value = F.col(column)
    bounds = (start.year * 10000 + start.month * 100 + start.day, end.year * 10000 + end.month * 100 + end.day)
    return Filter(table, (column_value >= F.lit(start)) & (column_value < F.lit(end)), bounds)


def filter_in_list(table: str, column: str, values: Sequence) -> Filter:
    return Filter(table, F.col(column).isin(list(values)))


def filter_not_null(table: str, column: str) -> Filter:
    return Filter(table, F.col(column).isNotNull())


def filter_not_contains_any(table: str, column: str, words: Sequence[str]) -> Filter:
    """``not contains a OR not contains b``: drops only the rows that contain every word."""
    text = F.lower(F.col(column))
    predicate = F.lit(False)
    for word in words:
        predicate = predicate | ~text.contains(word.lower())
    return Filter(table, predicate)


@dataclass(frozen=True)
class Model:
    """Named DataFrames and the join graph of every measure."""

    facts: Mapping[str, DataFrame]
    dimensions: Mapping[str, DataFrame]
    relationships: tuple[Relationship, ...]
    targets: DataFrame | None = None
    date_dimension: str = "dim_date"

    def key_between(self, fact: str, dimension: str) -> str | None:
        for link in self.relationships:
            if (link.fact, link.dimension) == (fact, dimension):
                return link.key
        return None


def restrict(model: Model, tables: Collection[str]) -> Model:
    """The model with the named tables only, so that no query touches a table it does not need."""
    return replace(
        model,
        facts={name: model.facts[name] for name in model.facts if name in tables},
        dimensions={name: model.dimensions[name] for name in model.dimensions if name in tables},
    )


def _month_before(key: int) -> int:
    """The month of the day before a yyyyMMdd key."""
    if key % 100 > 1:
        return key // 100
    year, month = divmod(key // 100, 100)
    return year * 100 + month - 1 if month > 1 else (year - 1) * 100 + 12


def propagate_filters(
    model: Model, filters: Sequence[Filter], columns: Mapping[str, Collection[str]] | None = None
) -> Model:
    """The model under a set of filters.

    ``columns`` names per fact what is read of it afterwards: the fact is reduced to those and to its keys
    after its own filters and before any join, so that a join that hashes rows reads no more.

    A dimension filter restricts the dimension and every fact related to it; a fact without
    the relationship is not filtered. A fact filter restricts that fact only.

    A fact with a month column is first restricted to the months that are left of the calendar:
    bounds of the filter as constants, and the months themselves by a join on the partition
    column, from which Spark prunes partitions when the query runs.
    """
    facts, dimensions = dict(model.facts), dict(model.dimensions)
    for item in filters:
        if item.table in facts:
            facts[item.table] = facts[item.table].filter(item.predicate)
            continue
        dimensions[item.table] = dimensions[item.table].filter(item.predicate)
    for fact, wanted in (columns or {}).items():
        keys = {link.key for link in model.relationships if link.fact == fact and link.dimension in dimensions}
        kept = {*wanted, *keys, MONTH}
        # A count of a fact without keys reads no column in particular.
        facts[fact] = facts[fact].select(*([c for c in facts[fact].columns if c in kept] or facts[fact].columns[:1]))
    for name in {item.table for item in filters if item.table in dimensions}:
        for link in model.relationships:
            if link.dimension != name or link.fact not in facts:
                continue
            fact = facts[link.fact]
            for item in filters:
                if item.table == name and item.key_range:
                    low, high = item.key_range
                    fact = fact.filter((F.col(link.key) >= low) & (F.col(link.key) < high))
                    if MONTH in fact.columns and name == model.date_dimension:
                        fact = fact.filter(F.col(MONTH).between(low // 100, _month_before(high)))
            if MONTH in fact.columns and name == model.date_dimension:
                # The calendar's months: 12 rows for each of its years.
                months = dimensions[name].select(month_of(link.key).alias(MONTH)).distinct()
                fact = fact.join(F.broadcast(months), MONTH, "left_semi")
            facts[link.fact] = keyed_join(fact, dimensions[name].select(link.key), [link.key], "left_semi")
    return replace(model, facts=facts, dimensions=dimensions)


def star_join(model: Model, fact: str, attributes: Sequence[tuple[str, str]], columns: Sequence[str] = ()) -> DataFrame:
    """A fact left-joined to the dimensions of the given (dimension, column) attributes.

    A null or unmatched key gives null attributes, the blank group. ``columns`` prunes the fact.
    Attributes of the fact itself are given as (fact, column).
    """
    result = model.facts[fact]
    by_dimension: dict[str, list[str]] = {}
    for table, column in attributes:
        if table != fact:
            by_dimension.setdefault(table, []).append(column)
    if columns:
        keys = [model.key_between(fact, dimension) for dimension in by_dimension]
        own = [column for table, column in attributes if table == fact]
        result = result.select(*dict.fromkeys([*columns, *own, *keys]))
    for dimension, names in by_dimension.items():
        key = model.key_between(fact, dimension)
        if key is None:
            raise ValueError(f"{fact} has no relationship to {dimension}")
        clash = [name for name in names if name in result.columns]
        member = model.dimensions[dimension].select(key, *names)
        result = keyed_join(result.drop(*clash), member, [key], "left")
    return result
