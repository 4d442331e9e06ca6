"""Profiling and data-quality checks. Each check returns a DataFrame; checks of one table share one pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.joins import keyed_join


def _long_form(wide: DataFrame, columns: Sequence[str], fields: dict[str, str], extra: Sequence[str] = ()) -> DataFrame:
    """One row per profiled column from the single row of a wide aggregate.

    ``fields`` maps an output column to the prefix of its aggregate, e.g. null_count -> 'nulls'.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                *[F.col(f"{prefix}_{i}").alias(out) for out, prefix in fields.items()],
            )
            for i, name in enumerate(columns)
        ]
    )
    return wide.select(*extra, F.inline(rows))


def profile_shape(df: DataFrame) -> DataFrame:
    """One row per column: name, type, position, with the row and column counts of the table."""
    schema = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
            )
            for i, field in enumerate(df.schema.fields, start=1)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).alias("column_count"), F.inline(schema)
    )


def profile_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count per column, all columns in one pass."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(name).isNull()).alias(f"nulls_{i}") for i, name in enumerate(columns)])
    return _long_form(wide, columns, {"null_count": "nulls"})


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum and mean per numeric column, all columns in one pass."""
    wide = df.agg(*[agg for i, name in enumerate(columns) for agg in _range_aggregates(i, name)])
    return _long_form(wide, columns, {"min_value": "min", "max_value": "max", "avg_value": "avg"})


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count, null count and value range per numeric column from one scan."""
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    for i, name in enumerate(columns):
        aggregates += _range_aggregates(i, name)
        aggregates.append(F.count_if(F.col(name).isNull()).alias(f"nulls_{i}"))
    fields = {"null_count": "nulls", "min_value": "min", "max_value": "max", "avg_value": "avg"}
    return _long_form(df.agg(*aggregates), columns, fields, extra=["row_count"])


def _range_aggregates(i: int, name: str) -> list[Column]:
    number = F.col(name).cast("double")
    return [F.min(number).alias(f"min_{i}"), F.max(number).alias(f"max_{i}"), F.avg(number).alias(f"avg_{i}")]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row, and their size."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def domain_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several columns with their counts, in one job."""
    text = df.select(*[F.col(name).cast("string").alias(name) for name in columns])
    return (
        text.unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def date_bounds(df: DataFrame, column: str) -> DataFrame:
    """First and last date."""
    day = F.to_date(column)
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def rows_with_nulls(df: DataFrame, any_of: Sequence[str]) -> DataFrame:
    """Rows where any of the columns is null."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(name).isNull() for name in any_of]))


def top_rows(df: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """The first ``n`` rows of an order; end the order with a unique column to make it repeatable."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 10, order: Sequence[Column] = ()) -> DataFrame:
    """``n`` rows to look at; any rows unless an order is given."""
    return top_rows(df, order, n) if order else df.limit(n)


def orphan_rows(df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None) -> DataFrame:
    """Rows whose key is missing from the reference. A null key counts as an orphan."""
    keys = reference.select(F.col(reference_key or key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return keyed_join(df, keys, [key], "left_anti").select(*df.columns)


def orphan_rows_nonnull(df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None) -> DataFrame:
    """Rows whose key is present but missing from the reference."""
    return orphan_rows(df.filter(F.col(key).isNotNull()), reference, key, reference_key)


def rule_violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows that break a rule across columns; a null operand does not break it."""
    return df.filter(~rule)


def bad_dates(df: DataFrame, column: str) -> DataFrame:
    """Rows whose date text is null or not a date."""
    return df.filter(F.col(column).try_cast("date").isNull())


def point_lookup(df: DataFrame, column: str, value) -> DataFrame:
    """The rows of one key value, e.g. to look at a repaired record."""
    return df.filter(F.col(column) == F.lit(value))


def fk_null_counts(fact: DataFrame, foreign_keys: Sequence[str]) -> DataFrame:
    """One row with the number of missing keys per foreign key; null on an empty fact."""
    return fact.agg(*[F.sum(F.col(key).isNull().cast("int")).alias(f"{key}_nulls") for key in foreign_keys])


def fk_containment(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows with a key that the dimension lacks; null keys are counted by fk_null_counts."""
    return orphan_rows_nonnull(fact, dimension, key)


def grain_uniqueness(fact: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Groups that break the declared grain."""
    return duplicate_keys(fact, grain)
