"""From documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents. Rows are told apart by a hash
of id and text, so null and repeated ids do no harm."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from claimwright.llm import decontaminate, jaccard, language, packing, pii
from claimwright.llm.common import order_id, stored, table, text_batches


#: So many keys of rows that go are broadcast, counted up to that bound; more are joined by shuffle.
FEW = 250_000


def stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage, whose texts go to workers in small batches."""
    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        text_batches(spark)
        return f(spark, docs, sf_dir)

    return run_stage


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose key is not in `gone` (key)."""
    gone = stored(gone.select(F.col("key").alias("_key")).distinct(), "gone")
    if gone.limit(FEW + 1).count() <= FEW:
        gone = F.broadcast(gone)  # texts stay where they are
    return docs.withColumn("_key", row_key()).join(gone, "_key", "left_anti").select(*docs.columns)


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of no language go."""
    found = language.identify(language.document_evidence(docs.withColumn("doc_id", row_key())),
                              docs.select("text", "lang"))
    return without(docs, found.where(~F.col("kept")).select(F.col("doc_id").alias("key")))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, likeness 0.8) the document with the smallest id stays."""
    keyed = docs.select(row_key().alias("key"), order_id().alias("id"), "text")
    groups = jaccard.similar_groups(keyed.select(F.col("key").alias("doc_id"), "text"), shingle=5, like=(80, 100)) \
        .where("n_shingles > 0").select(F.col("doc_id").alias("key"), "component_id").distinct()
    groups = stored(groups.join(keyed.groupBy("key").agg(F.min("id").alias("id")), "key"), "groups")
    stays = groups.groupBy("component_id").agg(F.min(F.struct("id", "key")).alias("stays"))
    gone = groups.join(stays, "component_id").where("key <> stays.key").select("key")
    kept = without(docs, gone)
    repeated = keyed.where(F.col("text") != "").groupBy("key").count().where("count > 1").select("key")
    if repeated.limit(1).count():  # rows with the same id and text
        again = kept.withColumn("_key", row_key()).join(repeated.select(F.col("key").alias("_key")), "_key", "left_semi")
        ordered = Window.partitionBy("_key").orderBy(*[c for c in docs.columns if c not in ("doc_id", "text")])
        once = again.withColumn("_rank", F.row_number().over(ordered)).where("_rank = 1")
        kept = without(kept, repeated).unionByName(once.select(*docs.columns))
    return kept


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    found = decontaminate.contamination(docs.select(row_key().alias("doc_id"), "text"),
                                        table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated").select(F.col("doc_id").alias("key")))


@stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by the name of its kind."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and offset."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL for the language model, the tagger and the plan: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stored(work(spark, docs, sf_dir), name)
    return docs
