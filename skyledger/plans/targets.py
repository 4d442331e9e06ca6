"""Time-effective targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.joins import fits_broadcast

# Blocks of 2^0 to 2^22 days: the last level holds all days that a date can name.
LEVELS = 23
DAY_ZERO = "0001-01-01"

# The blocks that cover the days from __begin to __end, at most two a level.
COVER = f"""filter(flatten(transform(sequence(0, {LEVELS - 1}), k -> transform(
    array(struct(shiftright(__begin + shiftleft(1, k) - 1, k) AS l, shiftright(__end + 1, k) AS r, true AS is_left),
          struct(shiftright(__begin + shiftleft(1, k) - 1, k) AS l, shiftright(__end + 1, k) AS r, false AS is_left)),
    x -> CASE WHEN x.l < x.r AND x.is_left AND x.l % 2 = 1 THEN struct(k AS level, x.l AS block)
              WHEN x.l < x.r AND NOT x.is_left AND x.r % 2 = 1 THEN struct(k AS level, x.r - 1 AS block) END))),
    x -> x IS NOT NULL)"""


def day_number(column: Column) -> Column:
    return F.datediff(column, F.lit(DAY_ZERO).cast("date"))


def blocks_of_day(number: Column) -> Column:
    """The block of each length that holds a day, as an array of (level, block)."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda k: F.struct(k.alias("level"), F.call_function("shiftright", number, k).alias("block"))
    )


def join_on_blocks(left: DataFrame, right: DataFrame, left_source: DataFrame, right_source: DataFrame) -> DataFrame:
    """Join two tables of (level, block) rows that were unrolled from their sources.

    The optimizer's estimates leave the unrolling out. Where a source is so small that even all its
    blocks fit a broadcast, the choice is left to it; else the join is asked not to broadcast.
    """
    small = fits_broadcast(left_source, 2 * LEVELS) or fits_broadcast(right_source, 2 * LEVELS)
    return left.join(right if small else right.hint("merge"), ["level", "block"])


def target_asof(
    dates: DataFrame, date_column: str, targets: DataFrame, kpi_codes: Sequence[str] | None = None
) -> DataFrame:
    """The largest target in force on each date, per KPI code.

    A target is in force from its start to its end, both inclusive; an open end has no limit.
    An interval is covered by blocks of 2^k days, at most two of each length, and the targets are
    reduced per block; a day looks up the blocks that hold it, one of each length. So dates and
    targets meet on equal keys, and no interval is unrolled to its days.
    """
    days = dates.filter(F.col(date_column).isNotNull()).select(F.col(date_column).cast("date").alias("__day")).distinct()
    first = days.agg(F.min("__day")).scalar()
    last = days.agg(F.max("__day")).scalar()
    if kpi_codes is not None:
        targets = targets.filter(F.col("kpi_code").isin(list(kpi_codes)))
    begin = F.greatest("effective_start_date", first)
    end = F.least(F.coalesce("effective_end_date", last), last)
    intervals = (
        targets.filter(F.col("effective_start_date").isNotNull())
        .select("kpi_code", "target_value", day_number(begin).alias("__begin"), day_number(end).alias("__end"))
        .filter(F.col("__begin") <= F.col("__end"))
        .groupBy("kpi_code", "__begin", "__end")
        .agg(F.max("target_value").alias("target_value"))
    )
    blocks = (
        intervals.select("kpi_code", "target_value", F.inline(F.expr(COVER)))
        .groupBy("kpi_code", "level", "block")
        .agg(F.max("target_value").alias("target_value"))
    )
    of_day = days.select("__day", F.inline(blocks_of_day(day_number(F.col("__day")))))
    found = join_on_blocks(of_day, blocks, days, targets).groupBy("__day", "kpi_code")
    return found.agg(F.max("target_value").alias("target_value")).withColumnRenamed("__day", date_column)


def target_columns(
    dates: DataFrame, date_column: str, targets: DataFrame, names: dict[str, str]
) -> DataFrame:
    """target_asof with one column per code: ``names`` maps a KPI code to its column."""
    active = target_asof(dates, date_column, targets, list(names))
    return active.groupBy(date_column).agg(
        *[F.max(F.when(F.col("kpi_code") == code, F.col("target_value"))).alias(name) for code, name in names.items()]
    )


def target_status(actual: Column, target: Column, direction: Column | str, blank_as_zero: bool = False) -> Column:
    """Met or Not Met by the direction, '>=' or '<='.

    A null actual or target has no status; with ``blank_as_zero`` a blank compares as 0.
    """
    if isinstance(direction, str):
        direction = F.lit(direction)
    if blank_as_zero:
        actual, target = F.coalesce(actual, F.lit(0.0)), F.coalesce(target, F.lit(0.0))
    met = F.when(direction == ">=", actual >= target).when(direction == "<=", actual <= target)
    return F.when(met, F.lit("Met")).when(~met, F.lit("Not Met"))


def target_variance(actual: Column, target: Column, blank_as_zero: bool = False) -> Column:
    """Actual minus target; with ``blank_as_zero`` one blank operand counts as 0."""
    if not blank_as_zero:
        return actual - target
    both_blank = actual.isNull() & target.isNull()
    return F.when(~both_blank, F.coalesce(actual, F.lit(0.0)) - F.coalesce(target, F.lit(0.0)))


def kpi_vs_target(
    df: DataFrame,
    actual: str = "actual",
    target: str = "target_value",
    direction: str = "target_direction",
    blank_as_zero: bool = False,
) -> DataFrame:
    """Add variance and status columns; the direction comes from the data."""
    a, t = F.col(actual), F.col(target)
    return df.withColumns(
        {
            "variance": target_variance(a, t, blank_as_zero),
            "target_status": target_status(a, t, F.col(direction), blank_as_zero),
        }
    )
