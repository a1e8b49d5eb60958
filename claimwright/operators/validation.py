"""Validity filter, rejected rows with reasons, and normalisation of claims."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from claimwright.functions.cleaning import capped, clamped, in_domain, parsed_timestamp
from claimwright.schema import AGE_RANGE, AMOUNT_CAP, BMI_RANGE, REGIONS, SEXES


def validity_checks() -> dict[str, Column]:
    """Name of each check and the predicate a valid claim fulfils."""
    return {
        "claim_id": F.col("claim_id").isNotNull(),
        "patient_id": F.col("patient_id").isNotNull(),
        "age": F.col("age").between(*AGE_RANGE),
        "bmi": F.col("bmi").between(*BMI_RANGE),
        "claim_amount": F.col("claim_amount") > 0,
        "region": F.col("region").isNotNull(),
    }


def validate(claims: DataFrame) -> DataFrame:
    """Claims that pass every check; a null counts as failing. Plain conjuncts, so Parquet scans push them."""
    for check in validity_checks().values():
        claims = claims.filter(check)
    return claims


def rejected(claims: DataFrame) -> DataFrame:
    """The complement of `validate`, each row with the array `reject_reasons` of its failed checks."""
    failed = [
        F.when(~F.coalesce(check, F.lit(False)), name) for name, check in validity_checks().items()
    ]
    return claims.withColumn("reject_reasons", F.array_compact(F.array(*failed))).filter(
        F.size("reject_reasons") > 0
    )


def reject_counts(claims: DataFrame) -> DataFrame:
    """Rows per failed check; a row that fails several checks counts in each."""
    return (
        rejected(claims)
        .select(F.explode("reject_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("rejected_rows"))
    )


def normalise(claims: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Domains, caps and parsed times, in one projection. `as_of` fixes `ingestion_ts`, by default the
    time of the batch."""
    return claims.withColumns({
        "sex": in_domain(F.col("sex"), SEXES),
        "region": in_domain(F.col("region"), REGIONS),
        "bmi": clamped(F.col("bmi"), *BMI_RANGE),
        "claim_amount": capped(F.col("claim_amount"), AMOUNT_CAP),
        "submission_ts": parsed_timestamp(F.col("submission_timestamp")),
        "ingestion_ts": F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp"),
    })
