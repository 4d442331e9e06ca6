"""Equi-joins that stay balanced when few keys hold most rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    FractionalType,
    MapType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

from skyledger.session import materialize

# A key is hot when it holds more than a share of the rows, so there are at most 1 / share of them.
# The share is half of what one of the shuffle partitions gets, within these bounds, and a hot key
# is spread over as many tasks as there are partitions, within those.
HOT_SHARES = (1 / 4000, 1 / 200)
SALTS = (64, 1024)

# Keys a heavy-hitter sketch keeps for each hot one, and number of slices it is merged in.
TRACKED = 10
SLICES = 256


def _hashable(kind: DataType) -> bool:
    """Whether a type holds no map and no variant, at any depth."""
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def row_hash(df: DataFrame) -> Column:
    """Hash of a row over all columns that can be hashed; 0 if there is none."""
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    return F.xxhash64(*hashable) if hashable else F.lit(0).cast("bigint")


def common_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> dict[str, str]:
    """The type in which the two sides' keys are compared, by key.

    Equal types stay. Numbers meet in a type that holds both, dates and times as times. Any
    other pair raises, whichever way the join is run: a text that happens to look like a number
    is no key of one.
    """
    kinds = {}
    for key in on:
        a, b = left.schema[key].dataType, right.schema[key].dataType
        times = (DateType, TimestampType, TimestampNTZType)
        alike = a == b or any(isinstance(a, t) and isinstance(b, t) for t in (NumericType, StringType, times))
        if not alike:
            raise TypeError(f"key {key} is {a.simpleString()} on the left and {b.simpleString()} on the right")
        kinds[key] = left.select(F.col(key)).union(right.select(F.col(key))).schema[0].dataType.simpleString()
    return kinds


def _key(column: Column, kind: str, is_float: bool) -> Column:
    """A key in the common type; a negative zero equals zero."""
    return column.cast(kind) + F.lit(0).cast(kind) if is_float else column.cast(kind)


def fits_broadcast(df: DataFrame, rows_each: int = 1) -> bool:
    """True if the optimizer's size estimate of ``df`` is below spark.sql.autoBroadcastJoinThreshold.

    Estimates of joins and aggregates are upper bounds, so an unsure case counts as large. They
    leave out what a row is unrolled to: ``rows_each`` is how many rows become of one at most.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) * rows_each <= limit


def hot_share(spark: SparkSession) -> float:
    """From which share of the rows on a key would make a shuffle task half as large again."""
    low, high = HOT_SHARES
    return min(max(1 / (2 * _partitions(spark)), low), high)


def salts_for(spark: SparkSession) -> int:
    """Over how many tasks the rows of a hot key are spread."""
    low, high = SALTS
    return min(max(_partitions(spark), low), high)


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys_of(
    df: DataFrame, keys: Mapping[str, Sequence[str | Column]], share: float | None = None
) -> dict[str, DataFrame]:
    """Per name the hashes (``__hash``) of the keys that hold more than ``share`` of the rows: 1 / share rows at most.

    One scan of all key columns with a heavy-hitter sketch of each key per slice of the tasks; no
    key is shuffled, and what leaves a slice is its top keys. The slices are written, so any number of
    joins uses the one scan. The counts are approximate, which can only cost balance: the joins
    are right for any set of hot keys.
    """
    share = share or hot_share(df.sparkSession)
    limit = int(1 / share)
    names = {name: f"__{i}" for i, name in enumerate(keys)}
    hashes = [F.xxhash64(*on).alias(f"__hash{names[name]}") for name, on in keys.items()]
    sketches = [F.expr(f"approx_top_k(__hash{at}, {limit}, {TRACKED * limit})").alias(f"__top{at}") for at in names.values()]
    slices = (
        df.select(*hashes, (F.spark_partition_id() % SLICES).alias("__slice"))
        .groupBy("__slice")
        .agg(F.count(F.lit(1)).alias("__rows"), *sketches)
    )
    if len(keys) > 1:
        slices = materialize(slices, "hot-keys")
    total = slices.agg(F.sum("__rows")).scalar()
    found = {}
    for name, at in names.items():
        counts = slices.select(F.inline(f"__top{at}")).groupBy("item").agg(F.sum("count").alias("__rows"))
        hot = counts.filter(F.col("__rows") > total * share)
        found[name] = hot.orderBy(F.desc("__rows")).limit(limit).select(F.col("item").alias("__hash"))
    return found


def hot_keys(df: DataFrame, on: Sequence[str | Column], share: float | None = None) -> DataFrame:
    """``hot_keys_of`` for one key."""
    return hot_keys_of(df, {"key": on}, share)["key"]


def compared_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[Column]:
    """The keys in the type in which the two sides compare them."""
    kinds = common_keys(left, right, on)
    floats = {k for k in on if any(isinstance(df.schema[k].dataType, FractionalType) for df in (left, right))}
    floats = {k for k in floats if not kinds[k].startswith("decimal")}
    return [_key(F.col(k), kinds[k], k in floats) for k in on]


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    measured: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join a possibly skewed ``left`` to keyed rows.

    A right side that fits a broadcast is left to Catalyst, which then moves no left row at
    all. Anything larger is joined by salted keys.
    """
    common_keys(left, right, on)
    if fits_broadcast(right):
        return left.join(right, list(on), how)
    return salted_join(left, right, on, how, measured, hot=hot)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    measured: DataFrame | None = None,
    share: float | None = None,
    salts: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join a large skewed ``left`` to a ``right`` that is too large to broadcast.

    The rows of hot keys, and the rows with a null key, are spread over ``salts`` tasks. Only
    the right rows of the hot keys are repeated, so the right side hardly grows. ``how`` is
    inner, left, left_semi or left_anti, each of which visits every left row once.

    ``measured`` has the same keys as ``left`` but is cheaper to scan, for instance the fact
    before its earlier lookups; ``hot`` has the hashes of its hot keys where they are known (hot_keys_of). The salt is a hash of the row, so a task that runs again deals
    its rows to the same places; exact copies of a row are left to adaptive skew splitting.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    on = list(on)
    # Both sides hash and meet in the common type, so a hot key is marked alike on both.
    keys = compared_keys(left, right, on)
    names = [f"__key{i}" for i in range(len(on))]
    salts = salts or salts_for(left.sparkSession)
    if hot is None:
        hot = hot_keys(left if measured is None else measured, keys, share)
    # At most 1 / share rows (4000 by the bounds), whatever the size of the tables.
    hot = F.broadcast(hot.withColumn("__hot", F.lit(True)))
    is_hot = F.coalesce(F.col("__hot"), F.lit(False))
    no_key = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in names])
    salt = F.pmod(row_hash(left), F.lit(salts)).cast("int")
    salted_left = (
        left.withColumns({"__salt": salt, "__hash": F.xxhash64(*keys), **dict(zip(names, keys, strict=True))})
        .join(hot, "__hash", "left")
        .withColumn("__salt", F.when(is_hot | no_key, F.col("__salt")).otherwise(F.lit(0)))
        .drop("__hash", "__hot")
    )
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = (
        right.withColumns({"__hash": F.xxhash64(*keys), **dict(zip(names, keys, strict=True))})
        .join(hot, "__hash", "left")
        .withColumn("__salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0)))))
        .drop("__hash", "__hot", *on)
    )
    # A table of each partition's right rows: the large left side is neither sorted nor spilled.
    joined = salted_left.join(salted_right.hint("shuffle_hash"), [*names, "__salt"], how).drop(*names, "__salt")
    others = [F.col(f"`{c}`") for c in joined.columns if c not in on]
    return joined.select(*on, *others)
