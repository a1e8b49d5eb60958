"""Provider and region statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimwright.operators.quantiles import exact_quantile

# Histogram step of the exact percentile: the amount cap of 500000 gives 10,001 buckets per region.
AMOUNT_STEP = 50.0


def provider_stats(claims: DataFrame) -> DataFrame:
    """Volume, average, maximum and fraud share per provider."""
    return claims.groupBy("provider_id").agg(
        F.count("*").alias("provider_total_claims"),
        F.avg("claim_amount").alias("provider_avg_claim"),
        F.max("claim_amount").alias("provider_max_claim"),
        F.avg(F.col("is_fraud").cast("double")).alias("provider_fraud_rate"),
    )


def region_stats(claims: DataFrame, *, accuracy: int | None = None) -> DataFrame:
    """Average, sample standard deviation and 95th percentile of the amount per region.

    The percentile is exact and the same in every run. With `accuracy` it is `percentile_approx` instead: one
    pass less, but each task then ships a digest per region to a handful of reducers, and the result varies
    with the partitioning."""
    moments = [
        F.avg("claim_amount").alias("region_avg_claim"),
        F.stddev("claim_amount").alias("region_stddev_claim"),
    ]
    if accuracy is not None:
        p95 = F.percentile_approx("claim_amount", 0.95, accuracy).alias("region_p95_claim")
        return claims.groupBy("region").agg(*moments, p95)
    p95 = exact_quantile(
        claims, "region", "claim_amount", 0.95,
        F.floor(F.col("claim_amount") / AMOUNT_STEP), "region_p95_claim",
    )
    return claims.groupBy("region").agg(*moments).join(p95, "region", "left")
