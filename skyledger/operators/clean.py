"""Cleaning. No operator here drops a row, except drop_blank_text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from skyledger.functions.numeric import whole_number
from skyledger.operators.joins import keyed_join
from skyledger.operators.ordering import POSITION, RANGE, order_ranges


def standardize_values(df: DataFrame, column: str, mapping: Mapping[str, str] | DataFrame) -> DataFrame:
    """Replace known variants by their canonical value; other values and nulls stay.

    A dict becomes a CASE expression. For a long list give a DataFrame (variant, canonical) with
    unique variants.
    """
    value = F.col(column)
    if isinstance(mapping, DataFrame):
        variants = mapping.select(F.col("variant").alias(column), F.col("canonical").alias("__canonical"))
        joined = keyed_join(df, variants, [column], "left")
        return joined.withColumn(column, F.coalesce("__canonical", column)).select(*df.columns)
    replaced = value
    for variant, canonical in mapping.items():
        replaced = F.when(value == variant, F.lit(canonical)).otherwise(replaced)
    return df.withColumn(column, replaced)


def null_invalid_refs(
    df: DataFrame,
    column: str,
    bad: Sequence | None = None,
    reference: DataFrame | None = None,
    reference_key: str | None = None,
) -> DataFrame:
    """Set an invalid foreign key to null and keep the row.

    Invalid is either one of the values in ``bad`` or, with ``reference``, a value that the
    reference lacks.
    """
    if bad is not None:
        return df.withColumn(column, F.when(F.col(column).isin(list(bad)), F.lit(None)).otherwise(F.col(column)))
    if reference is None:
        raise ValueError("give the invalid values or a reference")
    known = (
        reference.select(F.col(reference_key or column).alias(column))
        .filter(F.col(column).isNotNull())
        .distinct()
        .withColumn("__known", F.lit(True))
    )
    joined = keyed_join(df, known, [column], "left")
    return joined.withColumn(column, F.when(F.col("__known"), F.col(column))).select(*df.columns)


def fill_from_column(df: DataFrame, column: str, condition: Column, value: Column) -> DataFrame:
    """Fill a null where the condition holds. Run after the columns of the condition are standardised."""
    return df.withColumn(column, F.when(F.col(column).isNull() & condition, value).otherwise(F.col(column)))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed columns from text; a bad value becomes null. Integers may carry decimals."""
    casts = {
        name: whole_number(F.col(name)) if kind == "int" else F.col(name).try_cast(kind)
        for name, kind in types.items()
    }
    return df.withColumns(casts)


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every text column."""
    texts = [field.name for field in df.schema.fields if isinstance(field.dataType, StringType)]
    return df.withColumns({name: F.trim(F.col(name)) for name in texts}) if texts else df


def impute_neighbour_mean(
    df: DataFrame, order: Sequence[str], column: str, series: Sequence[str] = ()
) -> DataFrame:
    """Replace a null by the mean of the nearest earlier and nearest later value of its series.

    It stays null where either side has none. The series may be one long series or one that
    holds most rows: rows are cut into ordered ranges, each range is filled by its own windows,
    and the values at the range ends are carried over through one row per series and range.
    """
    order, series = list(order), list(series)
    ranged = order_ranges(df, [F.col(name) for name in (*series, *order)])
    present = F.when(F.col(column).isNotNull(), F.col(POSITION))
    ends = ranged.groupBy(*series, RANGE).agg(
        F.min_by(column, present).alias("__first"), F.max_by(column, present).alias("__last")
    )
    # Rows per window partition: at most the number of ranges.
    earlier = Window.partitionBy(*series).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*series).orderBy(F.desc(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(name).alias(f"__s{i}") for i, name in enumerate(series)],
        F.col(RANGE).alias("__r"),
        F.last("__last", ignorenulls=True).over(earlier).alias("__carried_prev"),
        F.last("__first", ignorenulls=True).over(later).alias("__carried_next"),
    )
    # "Next" is the last value of the reversed order: a frame that looks forward to the end of
    # the partition would be scanned again for every row.
    inside = Window.partitionBy(*series, RANGE)
    before = inside.orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    after = inside.orderBy(F.desc(POSITION)).rowsBetween(Window.unboundedPreceding, -1)
    filled = ranged.withColumns(
        {
            "__prev": F.last(column, ignorenulls=True).over(before),
            "__next": F.last(column, ignorenulls=True).over(after),
        }
    )
    match = F.col(RANGE) == F.col("__r")
    for i, name in enumerate(series):
        match = match & F.col(name).eqNullSafe(F.col(f"__s{i}"))
    mean = (F.coalesce("__prev", "__carried_prev") + F.coalesce("__next", "__carried_next")) / 2
    return (
        filled.join(carried, match, "left")
        .withColumn(column, F.when(F.col(column).isNull(), mean).otherwise(F.col(column)))
        .select(*df.columns)
    )


def flatten_struct(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Project nested fields: path -> column name."""
    return df.select(*[F.col(path).alias(name) for path, name in paths.items()])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position."""
    return df.toDF(*names)


def drop_blank_text(df: DataFrame, column: str) -> DataFrame:
    """Keep the rows whose text is present and not blank."""
    return df.filter(F.col(column).isNotNull() & (F.trim(F.col(column)) != ""))


def null_policy_report(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and nulls per stage, to show that cleaning kept every row and every meaningful null."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        nulls = [F.count_if(F.col(column).isNull()).alias(f"{column}_nulls") for column in columns]
        return df.agg(F.count(F.lit(1)).alias("row_count"), *nulls).withColumn("stage", F.lit(name))

    return stage(before, "before").unionByName(stage(after, "after"))
