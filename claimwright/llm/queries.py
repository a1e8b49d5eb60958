"""Registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.llm import (
    chat, decontaminate, editprint, jaccard, language, lattice, licenses, lpf, negatives, packing, pii, substring,
    whitening,
)
from claimwright.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), texts=False)


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lpf.remove_repeated_bytes(table(spark, sf_dir, "documents")).drop("spans")


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents")).drop("n_links")


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(language.document_evidence(docs), docs.select("text", "lang"))


@query
def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(language.page_evidence(table(spark, sf_dir, "pages")),
                              table(spark, sf_dir, "documents").select("text", "lang"))
    return found.withColumnRenamed("doc_id", "page_id")


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op2_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.with_edits(table(spark, sf_dir, "documents"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.file_licenses(licenses.as_files(table(spark, sf_dir, "documents")))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


#: Texts that hold the template's own control strings, as a conversation of their own.
CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query
def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string"))
    return chat.digests(chat.format_conversations(rows.withColumn("content", chat.text_part(F.col("text")))))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", noisy))
