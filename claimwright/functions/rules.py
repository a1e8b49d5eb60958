"""Transparent fraud rules and the signatures of known fraud patterns, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from claimwright.schema import (
    HIGH_RISK_PROCEDURES,
    IMPLAUSIBLE_WHEN_YOUNG,
    KNEE_REPLACEMENT,
    WATCHED_PROVIDER,
)

# The published rule parameters.
CHARGE_BASE, CHARGE_PER_YEAR, CHARGE_PER_BMI = 1800.0, 55.0, 35.0
SMOKER_FACTOR, CHARGE_PER_CHILD = 2.8, 450.0
INFLATION_FACTOR = 4.0
RAPID_DAYS, RAPID_AMOUNT = 7, 15000
YOUNG_AGE = 30
DEVIATION_LIMIT = 4.5
EXPECTED_FRAUD_PCT = (7.0, 9.0)


def expected_charge() -> Column:
    """Charge to be expected for a claimant's age, BMI, smoking and children."""
    body = CHARGE_BASE + F.col("age") * CHARGE_PER_YEAR + F.col("bmi") * CHARGE_PER_BMI
    factor = F.when(F.col("smoker"), SMOKER_FACTOR).otherwise(1.0)
    return body * factor + F.col("children") * CHARGE_PER_CHILD


def demographic_rules() -> dict[str, Column]:
    """The rules that need nothing but the claim itself; null never fires a rule."""
    amount = F.col("claim_amount")
    conditions = {
        "rule_inflation": amount > INFLATION_FACTOR * expected_charge(),
        "rule_rapid_high": (F.col("days_since_last_claim") <= RAPID_DAYS) & (amount > RAPID_AMOUNT),
        "rule_implausible_procedure": (F.col("age") < YOUNG_AGE)
        & F.col("procedure_code").isin(IMPLAUSIBLE_WHEN_YOUNG),
    }
    return {name: F.coalesce(cond, F.lit(False)) for name, cond in conditions.items()}


def provider_rule(watched_provider: str = WATCHED_PROVIDER) -> Column:
    """Claims of the watched provider, or far above their provider's average."""
    return F.coalesce(F.col("provider_id") == watched_provider, F.lit(False)) | F.coalesce(
        F.col("provider_claim_deviation") > DEVIATION_LIMIT, F.lit(False)
    )


def fraud_rules(watched_provider: str = WATCHED_PROVIDER) -> dict[str, Column]:
    """All four rules as booleans, never null."""
    return {**demographic_rules(), "rule_provider": provider_rule(watched_provider)}


def any_rule(rules: dict[str, Column]) -> Column:
    """True where at least one rule fires."""
    fired = F.lit(False)
    for condition in rules.values():
        fired = fired | condition
    return fired


def fraud_signatures() -> Column:
    """Names of the known fraud patterns a claim matches, in fixed order, as an array."""
    amount, days, age, bmi = (
        F.col(c) for c in ("claim_amount", "days_since_last_claim", "age", "bmi")
    )
    code = F.col("procedure_code")
    patterns = {
        "inflated_obese": bmi.between(42.0, 56.0) & (F.col("diagnosis_code") == "Z99.89"),
        "rapid_expensive": days.between(0, 3)
        & amount.between(18000, 52000)
        & code.isin(HIGH_RISK_PROCEDURES),
        "young_knee": age.between(19, 24)
        & (code == KNEE_REPLACEMENT)
        & amount.between(28000, 65000)
        & bmi.between(22.0, 27.0),
        "watched_provider": (F.col("provider_id") == WATCHED_PROVIDER)
        & F.col("smoker")
        & amount.between(22000, 48000)
        & days.between(1, 5),
    }
    return F.array_compact(F.array(*[F.when(cond, name) for name, cond in patterns.items()]))
