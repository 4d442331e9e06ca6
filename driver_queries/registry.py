"""Registry of queries and helpers that make results comparable with the SQL side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: int = 6) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its SQL text, if it has one."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(function(spark, sf_dir), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return function

    return register


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, integers as bigint, dates and times as text."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("double", "float"):
            column = F.round(column.cast("double"), digits)
        elif kind in ("tinyint", "smallint", "int"):
            column = column.cast("bigint")
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            column = column.cast("string")
        columns.append(column.alias(name))
    return df.select(*columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def f(expression: str, digits: int = 6) -> str:
    """SQL text of a rounded double."""
    return f"ROUND(CAST({expression} AS DOUBLE), {digits})"


def n(expression: str) -> str:
    """SQL text of a bigint."""
    return f"CAST({expression} AS BIGINT)"


def t(expression: str) -> str:
    """SQL text of a date, time or key as text."""
    return f"CAST({expression} AS VARCHAR)"
