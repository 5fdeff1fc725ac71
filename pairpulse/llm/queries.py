"""The registered queries of the operators: ``(spark, folder of the tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairpulse.llm import conversations, decontamination, embeddings, language, licenses, lines, mixing, near_dedup, paragraphs, personal_data, pieces, ranking, sharding
from pairpulse.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"), "doc_id")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                          "component_id")


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_counts(table(spark, sf_dir, "documents"))


def op5_interleaved_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleaved_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.linked_vectors(table(spark, sf_dir, "embeddings"))


def op7_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def op8_repeated_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_passages(table(spark, sf_dir, "documents"))


def op9_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("key"), "source", mixing.words_of().alias("size"))
    return mixing.mixed_copies(sizes).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))


def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identified(docs, language.fit(docs), "doc_id")
    return found.select("doc_id", language.is_held_out(F.col("doc_id")).alias("held_out"),
                        "lang_pred", "score")


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.token_digests(table(spark, sf_dir, "documents"), vocabulary)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digests(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_license_scan": op2_license_scan,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_interleaved_sharding": op5_interleaved_sharding,
    "op6_embedding_graph": op6_embedding_graph,
    "op7_contextual_pii": op7_contextual_pii,
    "op8_repeated_paragraphs": op8_repeated_paragraphs,
    "op9_pivotal_mixing": op9_pivotal_mixing,
    "op10_language_crf": op10_language_crf,
    "op11_piece_encoding": op11_piece_encoding,
    "op12_ranked_search": op12_ranked_search,
    "op13_conversation_repair": op13_conversation_repair,
}
