"""Global order without one task.

A window without ``partitionBy`` moves every row to one task. Here the rows are range
partitioned by the whole order, numbered inside their range, and the ranges are stitched
together through a table of one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.operators.joins import row_hash
from skyledger.session import materialize

RANGE = "__range"
POSITION = "__position"

# monotonically_increasing_id() keeps the partition number above the lowest 33 bits.
_POSITION_BITS = 33


def order_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort ``df`` globally and add the range number and the row position inside the range.

    The hash of all columns ends the order, so rows that tie on ``order`` still split into
    different ranges and keep the same place in every run. The result is written to the shared
    folder: range and position depend on the physical layout and must not be computed twice.
    """
    marked = df.orderBy(*order, row_hash(df)).withColumn("__id", F.monotonically_increasing_id())
    fixed = materialize(marked, "ordered")
    return fixed.select(
        *[f"`{name}`" for name in df.columns],
        F.shiftright("__id", _POSITION_BITS).alias(RANGE),
        F.col("__id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias(POSITION),
    )


def global_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``row_number`` over the whole table: gapless from 1, equal to a window without partitions."""
    ranged = order_ranges(df, order)
    sizes = ranged.groupBy(RANGE).agg((F.max(POSITION) + 1).alias("__rows"))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(RANGE, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    # One row per range, at most spark.sql.shuffle.partitions rows: always small enough to broadcast.
    return (
        ranged.join(F.broadcast(offsets), RANGE)
        .withColumn(name, F.col("__offset") + F.col(POSITION) + 1)
        .drop(RANGE, POSITION, "__offset")
    )
