"""One row per claim."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Which duplicate survives in a batch; the dearest first, then a total order.
SURVIVOR_ORDER = [
    "bmi", "provider_id", "submission_timestamp", "procedure_code", "diagnosis_code",
]


def survivor_order(columns: Sequence[str]) -> list[Column]:
    """Dearest claim first, then the fixed columns, then every remaining column, so the survivor never
    depends on how the rows were partitioned."""
    leading = [c for c in SURVIVOR_ORDER if c in columns]
    rest = [c for c in columns if c not in leading and c not in ("claim_id", "claim_amount")]
    return [F.col("claim_amount").desc(), *[F.col(c) for c in (*leading, *rest)]]


def dedup_claims(claims: DataFrame, key: str = "claim_id",
                 order: Sequence[Column] | None = None) -> DataFrame:
    """The first row per key in `order`.

    `row_number() = 1` plans as a group limit on both sides of the shuffle: every map task sends at most one
    row per key, so a key that holds much of the table reaches its reducer as one row per task."""
    ranked = Window.partitionBy(key).orderBy(*(order or survivor_order(claims.columns)))
    return claims.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
