"""Names, scratch tables and numbers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import materialize, scratch_path

__all__ = ["materialize", "scratch_path", "shuffle_partitions", "id_and_text", "in_bucket", "rows_of_ids", "with_row_keys", "for_python", "ids_of", "batches_of_bytes", "plans_not_compiled"]

# rows_of_ids broadcasts one bit for each of so many hash slots: 2 MB, whatever the number of ids.
ID_SLOTS = 1 << 24
SLOTS_IN_MAP = 1 << 15

BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
WHOLE_STAGE = "spark.sql.codegen.wholeStage"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty), so no other column can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def in_bucket(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) leaves ``remainder``; false for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def with_row_keys(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a long that names a row: its ``doc_id``, or where that is null or shared, a hash of id and text.

    Rows with equal id and text have one key. Hashes are at 2^62 and above. Only the ids that
    several rows share are joined to the rows, and they are written first, so their size is known.
    """
    ids = docs.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("__shared"))
    shared = materialize(ids.agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("__shared"), "shared-ids")
    own = F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    alone = F.col("doc_id").isNotNull() & F.col("__shared").isNull()
    key = F.when(alone, F.col("doc_id").cast("long")).otherwise(own).alias(name)
    joined = docs.join(shared, docs["doc_id"].cast("long") == F.col("__shared"), "left")
    return joined.select(*[docs[f"`{c}`"] for c in docs.columns], key)


def rows_of_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``rows`` whose ``doc_id`` is among ``ids`` (``doc_id``).

    A broadcast bit map of fixed size drops most other rows before the shuffle; the join after it
    is exact. With more ids than slots the map drops less, and the result is the same. The join is
    an inner one with distinct ids: a semi-join would be pushed below the map and move all rows.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(ID_SLOTS))
    place = (slot % SLOTS_IN_MAP).alias("__place")
    number = F.floor(slot / SLOTS_IN_MAP).cast("int").alias("__map")
    maps = ids.select(number, place).groupBy("__map").agg(F.call_function("bitmap_construct_agg", "__place").alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", (F.col("__place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.pow(F.lit(2), F.col("__place") % 8).cast("int")) != 0
    near = rows.withColumns({"__map": number, "__place": place}).join(F.broadcast(maps), "__map").filter(is_set)
    near = near.select(*[f"`{c}`" for c in rows.columns])
    return near.join(ids.select("doc_id").distinct(), "doc_id")


def for_python(rows: DataFrame) -> DataFrame:
    """``doc_id`` without nulls and ``no_id``: pandas would turn ids beside a null into floats."""
    return rows.withColumns({"no_id": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0))})


def ids_of(frame: pd.DataFrame) -> pd.Series:
    """The ids of a batch of ``for_python`` with its nulls."""
    return frame["doc_id"].astype("Int64").mask(frame["no_id"].astype(bool))


@contextmanager
def batches_of_bytes(spark: SparkSession, limit: int) -> Iterator[None]:
    """Rows that go to Python while the block runs go in batches of about ``limit`` bytes.

    A batch lies whole in the executor's direct memory, which is kept for the next one, and in the worker.
    """
    before = spark.conf.get(BATCH_LIMIT)
    spark.conf.set(BATCH_LIMIT, f"{limit}b")
    try:
        yield
    finally:
        spark.conf.set(BATCH_LIMIT, before)


@contextmanager
def plans_not_compiled(spark: SparkSession) -> Iterator[None]:
    """Stages that run inside the block are not made into classes of their own.

    The driver compiles and keeps those classes, which many small plans do not earn back.
    """
    before = spark.conf.get(WHOLE_STAGE)
    spark.conf.set(WHOLE_STAGE, "false")
    try:
        yield
    finally:
        spark.conf.set(WHOLE_STAGE, before)
