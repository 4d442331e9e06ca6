"""Tables that are replaced as a whole: a version is written beside the others, then published.

A table is a folder with one folder per version (``data/<id>``) and a log (``log``) with one small
file per publication. Readers take the newest entry of the log. A version that was not written to its end, or that
failed its checks, has no entry, so readers keep the one before; a plan that was made from an
earlier version goes on reading its files, also if it feeds the version that replaces it.

The entry is one file that the commit of a Spark job moves into the log: there is no moment
without a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.sources.checked import CheckFailed, observed
from skyledger.folders import remove_folder

# Old versions that one call removes at most; the next call goes on.
MOST_REMOVED = 1000

ENTRY = "version long, folder string, table_schema string, row_count long, published_at timestamp"


def _log_path(path: str) -> str:
    return f"{path.rstrip('/')}/log"


def table_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per publication of the table; none before the first."""
    try:
        return spark.read.schema(ENTRY).json(_log_path(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRY)


def _newest_first(entries: DataFrame) -> DataFrame:
    # Two writers may have published the same number: the later one counts, on every read.
    return entries.orderBy(F.desc("version"), F.desc("published_at"), F.desc("folder"))


def _newest(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    entries = table_log(spark, path)
    if version is not None:
        entries = entries.filter(F.col("version") == version)
    return _newest_first(entries).first()


def replace_table(
    df: DataFrame,
    path: str,
    *,
    rules: Mapping[str, Column] | None = None,
    allowed: Mapping[str, int] | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """Write ``df`` as the next version of the table at ``path`` and publish it.

    ``rules`` are conditions every row has to meet (a null result meets it); they are counted by the
    write job itself. If one is broken by more rows than ``allowed`` says (0 by default) the version is
    not published and CheckFailed is raised. Returns the counts: ``check_name, row_count``.
    """
    spark = df.sparkSession
    newest = _newest(spark, path)
    folder = f"{path.rstrip('/')}/data/{uuid.uuid4().hex}"
    watched, counts = observed(df, rules or {})
    writer = watched.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(folder)
    report = counts()
    broken = {name: n for name, n in report.items() if name in (rules or {}) and n > (allowed or {}).get(name, 0)}
    if broken:
        raise CheckFailed(f"{path} is not replaced, rules are broken: {broken}")
    version = newest["version"] + 1 if newest else 1
    entry = spark.range(1).select(
        F.lit(version).cast("long").alias("version"),
        F.lit(folder).alias("folder"),
        F.lit(df.schema.json()).alias("table_schema"),
        F.lit(report["rows"]).cast("long").alias("row_count"),
        F.current_timestamp().alias("published_at"),
    )
    entry.coalesce(1).write.mode("append").json(_log_path(path))
    return spark.createDataFrame(list(report.items()), "check_name string, row_count long")


def scan_version(spark: SparkSession, path: str, version: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The newest version of the table, or an older one that was not removed."""
    entry = _newest(spark, path, version)
    if entry is None:
        raise ValueError(f"{path} has no version {version or ''}".rstrip())
    schema = StructType.fromJson(json.loads(entry["table_schema"]))
    # Columns that name folders come last when they are read back.
    return spark.read.format(fmt).schema(schema).load(entry["folder"]).select(*[f"`{name}`" for name in schema.names])


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove the files of all but the newest ``keep`` published versions; their log entries stay.

    Plans made from a removed version can no longer run, so keep as many as readers may hold.
    """
    if keep < 1:
        raise ValueError("the newest version has to stay")
    # A row per publication: a count of refreshes, not of data.
    for entry in _newest_first(table_log(spark, path)).offset(keep).take(MOST_REMOVED):
        remove_folder(entry["folder"])
