"""One query per operator over the driver tables; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import alignment, block_search, context_mixing, conversation_trie, decontamination, jaccard_join, licences, nbsvm, packing, pii, substrings, warc, wavelet
from skyledger.llm.oracle import ORACLE
from skyledger.llm.shared import in_bucket
from skyledger.llm.shipping import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_wavelet_tokens")
def wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.wavelet_round_trip(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, end_id=2)


@query("op2_jaccard_join")
def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_licence_scan")
def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@query("op4_context_mixing")
def mixing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score_texts(table(spark, sf_dir, "documents"), ~in_bucket("doc_id", 5, 1))


@query("op5_cost_packing")
def cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY, end_id=1)


@query("op6_block_search")
def block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.top_products(table(spark, sf_dir, "embeddings"), every=50, k=5)


@query("op7_warc_index")
def warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_benchmark_items")
def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "bm25", "question_share", "answer_share", "first_word")


@query("op9_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.base_report(table(spark, sf_dir, "documents"))


@query("op10_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = nbsvm.train(docs, table(spark, sf_dir, "labels"), ~in_bucket("doc_id", 4, 2))
    scored = nbsvm.with_quality(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= nbsvm.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", in_bucket("doc_id", 4, 2).alias("held_out"), "score", predicted)


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align_documents(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("").alias("groups_sha256")
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


@query("op12_prefix_trie")
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_repeated_passages")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


__all__ = ["ORACLE", "QUERIES"]
