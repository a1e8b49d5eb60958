"""Hourly claim counts over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def hourly_counts(claims: DataFrame, *, ts: str = "ingestion_ts", delay: str = "1 hour") -> DataFrame:
    """Normal and fraud claims per hour, each hour once, when the watermark has passed its end.

    Counts are combined before the shuffle, so a busy hour sends one row per task."""
    stamped = claims.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    return stamped.groupBy(F.window("_ts", "1 hour")).agg(
        F.count_if(~F.col("is_fraud")).alias("normal_claims"),
        F.count_if("is_fraud").alias("fraud_claims"),
    ).select(F.col("window.start").alias("time"), "normal_claims", "fraud_claims")
