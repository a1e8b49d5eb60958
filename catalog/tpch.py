"""Deterministic claims derived from order tables (one claim message per order line), for tests and timing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.functions.rules import any_rule, demographic_rules
from claimwright.schema import CLAIM_SCHEMA, PROCEDURES, WATCHED_PROVIDER


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with customer and region keys. No join hints: file sizes decide what is broadcast."""
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    lines, orders, customers, nations = (table(t) for t in ("lineitem", "orders", "customer", "nation"))
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
    )


def claim_columns() -> dict:
    """The claim fields except `is_fraud`, as integer arithmetic on the keys."""
    order, cust, part, supp, line = (
        F.col(c) for c in ("l_orderkey", "o_custkey", "l_partkey", "l_suppkey", "l_linenumber")
    )
    codes = F.array(*[F.lit(c) for c in PROCEDURES])
    names = F.array(*[F.lit(n) for n in PROCEDURES.values()])
    region_text = F.array(*[F.lit(r) for r in (" Northeast ", "northwest", "SOUTHEAST", "southwest", "overseas")])
    sex_text = F.array(*[F.lit(s) for s in ("male", "female", " Female ", "X")])
    sign = F.when(order % 101 == 0, 40.0).when(order % 101 == 1, -1.0).otherwise(1.0)
    code_slot = (part % 10 + 1).cast("int")
    return {
        "claim_id": F.concat(F.lit("C"), order, F.lit("-"), line),
        "patient_id": F.concat(F.lit("P"), cust),
        "age": F.when(order % 97 == 0, 0).when(order % 97 == 1, 120).otherwise(18 + (cust * 7) % 70).cast("int"),
        "sex": F.element_at(sex_text, (cust % 4 + 1).cast("int")),
        "bmi": F.when(order % 89 == 0, 75.0).otherwise(15.0) + ((part * 37) % 400).cast("double") / 10.0,
        "children": (cust % 5).cast("int"),
        "smoker": cust % 5 == 0,
        "region": F.when(order % 83 != 0, F.element_at(region_text, F.col("n_regionkey") + 1)),
        "claim_amount": sign * F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) / 3.0,
        "procedure_code": F.element_at(codes, code_slot),
        "procedure_description": F.element_at(names, code_slot),
        "provider_id": F.when(supp % 25 == 0, WATCHED_PROVIDER).otherwise(F.concat(F.lit("PRV"), supp + 1000)),
        "submission_timestamp": F.when(order % 79 == 0, "bad-ts").otherwise(
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
        ),
        "days_since_last_claim": ((order * 13 + line * 31) % 365).cast("int"),
        "diagnosis_code": F.when(part % 50 == 0, "Z99.89").otherwise(F.concat(F.lit("D"), part % 90 + 10)),
    }


def envelope_columns() -> dict:
    """Arrival metadata of the messages."""
    return {
        "kafka_ts": F.col("l_shipdate").cast("timestamp"),
        "kafka_offset": F.col("l_orderkey") * 8 + F.col("l_linenumber"),
        "kafka_partition": (F.col("l_suppkey") % 4).cast("int"),
    }


def source_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unvalidated claims with arrival metadata; ids repeat and some rows are invalid."""
    rows = order_lines(spark, sf_dir).select(
        *[c.alias(n) for n, c in {**claim_columns(), **envelope_columns()}.items()]
    )
    fraud = any_rule(demographic_rules()) | (F.col("provider_id") == WATCHED_PROVIDER)
    return rows.withColumn("is_fraud", fraud).select(
        *[f.name for f in CLAIM_SCHEMA], "kafka_ts", "kafka_offset", "kafka_partition"
    )
