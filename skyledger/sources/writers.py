"""Sinks and literal tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from skyledger.session import materialize


def sink_overwrite(
    df: DataFrame,
    path: str,
    *,
    reads_target: bool = False,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Replace the table at ``path``.

    A plan that reads the table it replaces is first written to the shared folder, since the
    overwrite removes its input. With ``partition_by`` only the partitions present in ``df``
    are replaced, so a refresh does not rewrite the whole table.
    """
    if reads_target:
        df = materialize(df, "staged")
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.save(path)


def sink_overwrite_schema(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the table and its schema. Parquet always does; a table format needs the option."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").save(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table from literal rows with a declared schema."""
    return spark.createDataFrame(list(rows), schema)
