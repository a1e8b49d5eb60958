"""The benchmark workloads over the feature table. Timing is the caller's business."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimwright.operators.joins import with_key_stats
from claimwright.operators.sampling import SEED, uniform
from claimwright.session import scratch_dir
from claimwright.sources.tables import save_parquet

# Workload parameters.
FILTER_AMOUNT = 10000
FRACTIONS = [0.25, 0.5, 1.0]


def full_scan_count(features: DataFrame) -> DataFrame:
    return features.agg(F.count("*").alias("num_records"))


def filter_project(features: DataFrame) -> DataFrame:
    return features.filter(F.col("claim_amount") > FILTER_AMOUNT).select(
        "claim_id", "claim_amount", "region", "is_fraud"
    )


def group_by(features: DataFrame) -> DataFrame:
    return features.groupBy("region", "bmi_category").agg(
        F.count("*").alias("cnt"),
        F.avg("claim_amount").alias("avg_claim"),
        F.sum(F.col("is_fraud").cast("int")).alias("fraud_count"),
    )


def join_provider_average(features: DataFrame) -> DataFrame:
    """Claims with the average amount of their provider, `p_avg`."""
    averages = save_parquet(features.groupBy("provider_id").agg(
        F.avg("claim_amount").alias("p_avg"), F.count("*").alias("_claims")
    ), scratch_dir(features.sparkSession, "averages"))  # counted and joined, aggregated once
    return with_key_stats(
        features.select("claim_id", "provider_id", "claim_amount"), averages, "provider_id", "_claims",
        F.col("claim_id"),
    ).drop("_claims")


def scaling(features: DataFrame, seed: int = SEED) -> DataFrame:
    """Rows and average amount per region over growing samples of the rows, in one pass: each row is in the samples
    whose fraction is above its draw."""
    drawn = features.select("region", "claim_amount", uniform("claim_id", seed).alias("draw"))
    entries = []
    for f in FRACTIONS:
        inside = F.col("draw") < f
        entries.append(F.struct(F.lit(f).alias("fraction"), F.count_if(inside).alias("cnt"),
                                F.avg(F.when(inside, F.col("claim_amount"))).alias("avg_amount")))
    by_region = drawn.groupBy("region").agg(F.array(*entries).alias("samples"))
    return by_region.select("region", F.explode("samples").alias("s")).select("s.fraction", "region", "s.cnt",
                                                                             "s.avg_amount").filter("cnt > 0")
