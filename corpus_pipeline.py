"""A corpus pipeline: quality, near duplicates, test items, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents that it leaves, whole and with
all their columns; the last one returns the pieces of packed sequences. The result of a stage is
written as Parquet and read again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import decontamination, jaccard_join, nbsvm, packing, pii
from skyledger.llm.shared import in_bucket, materialize, with_row_keys
from skyledger.llm.shipping import ship_package


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{name}`") for name in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; null and empty texts are scored too."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = nbsvm.train(docs, labels, ~in_bucket("doc_id", 4, 2))
    scored = nbsvm.with_quality(docs, model, "__score")
    return scored.filter(F.col("__score") >= nbsvm.THRESHOLD).select(*_columns(docs))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the smallest id, one without id only where no other is there.

    Rows that share an id are documents of their own; those that share id and text are one. A document
    without words is in no group and stays.
    """
    ship_package(spark)
    keyed = with_row_keys(docs, "__key")
    found = jaccard_join.near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias("__key"), F.col("component_id").alias("__group")).distinct()
    ids = keyed.select("__key", F.col("doc_id").cast("long").alias("__id")).distinct()
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__key"))
    kept = groups.join(ids, "__key").groupBy("__group").agg(first.alias("first")).select(F.col("first.__key").alias("__key"))
    return keyed.join(kept, "__key").dropDuplicates(["__key"]).select(*_columns(docs))


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item is found, each row judged by its own text; repeated rows stay."""
    ship_package(spark)
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*_columns(docs))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each span of personal data replaced by its kind; null texts stay null."""
    return pii.redact(docs).select(*_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens; a null text is empty, every row counts."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("test_items", drop_test_items),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

# The classifier, the tokens and the packing are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
