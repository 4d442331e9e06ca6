"""Tables partitioned by month that are refreshed where their source changed.

A table is a folder of loads (``data/load=<id>/month_key=<yyyyMM>``) and a log with one small row per
load and month it replaced. The newest row of a month says which load holds it, and its fingerprint: row
count, xor and sum of the hashes of that month's source rows. A refresh compares fingerprints,
rebuilds the months that differ into a new load and publishes all of them with one file; other
months keep their files, and readers see either all of a refresh or nothing of it.

A reader joins the partitions to the newest rows of the log, so Spark prunes the partitions of
older loads, and a filter on months or on a calendar joined by month prunes the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.operators.joins import row_hash
from skyledger.session import materialize

# The partition column: year * 100 + month, 0 for rows without a date.
MONTH = "month_key"
LOAD = "load"

ENTRY = f"{MONTH} int, {LOAD} string, row_count long, print_a long, print_b long, published_at timestamp"
PRINTS = ["row_count", "print_a", "print_b"]


def month_of(date_key: str | Column) -> Column:
    """The month of a yyyyMMdd key; 0 for a null key."""
    column = F.col(date_key) if isinstance(date_key, str) else date_key
    return F.coalesce(F.floor(column / 100), F.lit(0)).cast("int")


def month_of_day(day: Column) -> Column:
    """The month of a date or timestamp; 0 for null."""
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0)).cast("int")


def _log(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(ENTRY).json(f"{path.rstrip('/')}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRY)


def month_log(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of every month; one with 0 rows has no files."""
    newest = Window.partitionBy(MONTH).orderBy(F.desc("published_at"), F.desc(LOAD))
    entries = _log(spark, path).withColumn("__n", F.row_number().over(newest))
    return entries.filter("__n = 1").drop("__n")


def fingerprints(source: DataFrame, month: Column, salt: str = "") -> DataFrame:
    """Rows, an xor and a sum of row hashes per month: equal for equal bags of rows, in any order or layout.

    ``salt`` goes into every hash: give it a text that changes with whatever else a build reads.
    """
    # Equal rows cancel out of the xor, so 24 bits are summed as well: below 2^39 rows that cannot overflow.
    hashed = source.select(month.alias(MONTH), F.xxhash64(row_hash(source), F.lit(salt)).alias("__h"))
    low = F.col("__h").bitwiseAND(F.lit((1 << 24) - 1))
    return hashed.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("row_count"), F.bit_xor("__h").alias("print_a"), F.sum(low).alias("print_b")
    )


def refresh_months(
    source: DataFrame,
    path: str,
    month: Column,
    build: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    date_key: str = "date_key",
    salt: str = "",
) -> DataFrame:
    """Bring the table at ``path`` up to date with ``source`` and return the months that were rebuilt.

    ``month`` gives the month of a source row; ``build`` makes the table's rows of source rows and must keep
    them in their month, which is taken from ``date_key`` of what it makes. It sees the rows of changed
    months only. Returns ``month_key, row_count`` (of the source; 0: the month is gone). One scan of the
    source finds the changes; a second one, of those months, happens only if there are any.
    """
    spark = source.sparkSession
    found = fingerprints(source, month, salt)
    known = month_log(spark, path).select(MONTH, *[F.col(c).alias(f"__{c}") for c in PRINTS])
    both = found.join(known, MONTH, "full").fillna(0, [*PRINTS, *[f"__{c}" for c in PRINTS]])
    differs = F.lit(False)
    for c in PRINTS:
        differs = differs | (F.col(c) != F.col(f"__{c}"))
    # One row per month: written, so that what is rebuilt and what is published are the same months.
    changed = materialize(both.filter(differs).select(MONTH, *PRINTS), "changed")
    if changed.isEmpty():
        return changed.select(MONTH, "row_count")
    load = uuid.uuid4().hex
    rows = source.withColumn("__month", month).join(
        F.broadcast(changed.filter("row_count > 0").select(F.col(MONTH).alias("__month"))), "__month", "left_semi"
    )
    built = build(rows.drop("__month")).withColumn(MONTH, month_of(date_key))
    # Tasks of even size whatever the months' sizes: a large month is cut, small ones share a task.
    built.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(f"{path.rstrip('/')}/data/{LOAD}={load}")
    entries = changed.select(MONTH, F.lit(load).alias(LOAD), *PRINTS, F.current_timestamp().alias("published_at"))
    entries.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/log")
    return changed.select(MONTH, "row_count")


def scan_months(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The rows of the newest load of every month, with ``month_key``.

    ``schema`` are the columns of the table without the month; by default they are read from its files.
    """
    data = f"{path.rstrip('/')}/data"
    reader = spark.read.option("basePath", data)
    if schema:
        reader = reader.schema(f"{schema}, {LOAD} string, {MONTH} int")
    rows = reader.parquet(data)
    # At most one row per month of the table.
    current = F.broadcast(month_log(spark, path).filter("row_count > 0").select(LOAD, MONTH))
    joined = rows.join(current, [LOAD, MONTH])
    return joined.select(*[f"`{c}`" for c in rows.columns if c != LOAD])
