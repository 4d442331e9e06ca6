"""Views of the driver tables with faults put in by fixed rules, in both languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import table

# name: (driver table, column, expression)
FAULTS = {
    "events_null_value": ("events", "value", "CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END"),
    "events_variant_type": (
        "events",
        "event_type",
        "CASE WHEN event_id % 50 = 0 AND event_type = 'purchase' THEN 'PUR' ELSE event_type END",
    ),
    "events_bad_ts": (
        "events",
        "ts",
        "CASE WHEN event_id % 89 = 0 THEN 'bad-date' ELSE CAST(CAST(ts AS DATE) AS STRING) END",
    ),
    "lineitem_bad_supplier": (
        "lineitem",
        "l_suppkey",
        "CASE WHEN l_orderkey % 101 = 0 THEN -1 ELSE l_suppkey END",
    ),
    "lineitem_null_supplier": (
        "lineitem",
        "l_suppkey",
        "CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN -1 ELSE l_suppkey END",
    ),
    "conversations_blank_text": (
        "conversations",
        "text",
        "CASE WHEN turn % 5 = 0 THEN '  ' WHEN turn % 5 = 1 THEN NULL ELSE text END",
    ),
}


def dirty(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, column, expression = FAULTS[name]
    return table(spark, sf_dir, source).withColumn(column, F.expr(expression))


def dirty_sql(name: str) -> str:
    source, column, expression = FAULTS[name]
    return f"(SELECT * REPLACE ({expression} AS {column}) FROM {source})"
