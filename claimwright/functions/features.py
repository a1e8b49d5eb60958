"""Feature expressions over a claim row joined with its provider and region statistics.

Every expression is a built-in Catalyst expression over input columns only, so all of them go into one
projection and one generated stage. Null inputs take the last branch of a category and leave a flag at 0.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from claimwright.functions.cleaning import flag
from claimwright.schema import (
    HIGH_RISK_PROCEDURES,
    KNEE_REPLACEMENT,
    MEDIUM_RISK_PROCEDURES,
    WATCHED_PROVIDER,
)

# Thresholds of the feature definitions.
BMI_STEPS = [(18.5, "underweight"), (25.0, "normal"), (30.0, "overweight")]
BMI_TOP = "obese"
AGE_STEPS = [(30, "young"), (50, "middle"), (65, "senior")]
AGE_TOP = "elderly"
OBESE_BMI = 30.0
HIGH_VALUE = 20000
RAPID_DAYS = 7
YOUNG_AGE = 30
SCORE_WEIGHTS = {
    "high_value_claim": 2,
    "smoker_obese_flag": 1,
    "rapid_resubmission": 3,
    "young_high_procedure_flag": 2,
    "provider_high_volume_flag": 2,
    "claim_above_region_p95": 1,
}


def stepped(col: Column, steps: list[tuple[float, str]], top: str) -> Column:
    """Name of the first step whose upper bound exceeds `col`."""
    bound, name = steps[0]
    ladder = F.when(col < bound, name)
    for bound, name in steps[1:]:
        ladder = ladder.when(col < bound, name)
    return ladder.otherwise(top)


def category_columns() -> dict[str, Column]:
    """Categories; these need no statistics."""
    code = F.col("procedure_code")
    return {
        "bmi_category": stepped(F.col("bmi"), BMI_STEPS, BMI_TOP),
        "age_group": stepped(F.col("age"), AGE_STEPS, AGE_TOP),
        "procedure_risk": F.when(code.isin(HIGH_RISK_PROCEDURES), "high")
        .when(code.isin(MEDIUM_RISK_PROCEDURES), "medium")
        .otherwise("low"),
    }


def flag_columns(watched_provider: str = WATCHED_PROVIDER) -> dict[str, Column]:
    """Risk indicators as int 0/1."""
    amount = F.col("claim_amount")
    return {
        "smoker_obese_flag": flag(F.col("smoker") & (F.col("bmi") >= OBESE_BMI)),
        "high_value_claim": flag(amount > HIGH_VALUE),
        "rapid_resubmission": flag(F.col("days_since_last_claim") <= RAPID_DAYS),
        "young_high_procedure_flag": flag(
            (F.col("age") < YOUNG_AGE) & (F.col("procedure_code") == KNEE_REPLACEMENT)
        ),
        "provider_high_volume_flag": flag(F.col("provider_id") == watched_provider),
        "claim_above_region_p95": flag(amount > F.col("region_p95_claim")),
    }


def amount_columns() -> dict[str, Column]:
    """Ratios and transforms of the claim amount."""
    amount, spread = F.col("claim_amount"), F.col("region_stddev_claim")
    return {
        "charge_per_age": F.round(F.try_divide(amount, F.col("age").cast("double") + 1.0), 4),
        "log_claim_amount": F.log1p(amount),
        "claim_zscore_region": F.when(
            spread > 0, F.try_divide(amount - F.col("region_avg_claim"), spread)
        ).otherwise(0.0),
        "provider_claim_deviation": F.when(
            F.col("provider_avg_claim").isNotNull(),
            F.round(F.try_divide(amount, F.col("provider_avg_claim") + 1.0), 4),
        ).otherwise(1.0),
    }


def anomaly_score(flags: dict[str, Column]) -> Column:
    """Weighted sum of the risk indicators, 0 to 11."""
    total = F.lit(0)
    for name, weight in SCORE_WEIGHTS.items():
        total = total + flags[name] * weight
    return total.cast("double")


def engineered_columns(watched_provider: str = WATCHED_PROVIDER) -> dict[str, Column]:
    """All fourteen engineered columns, in table order."""
    categories, amounts = category_columns(), amount_columns()
    flags = flag_columns(watched_provider)
    columns = {**categories, **amounts, **flags, "anomaly_score_proxy": anomaly_score(flags)}
    return {name: columns[name] for name in ENGINEERED}


# Order of the engineered columns in the feature table.
ENGINEERED = [
    "charge_per_age",
    "bmi_category",
    "age_group",
    "procedure_risk",
    "smoker_obese_flag",
    "high_value_claim",
    "rapid_resubmission",
    "young_high_procedure_flag",
    "provider_high_volume_flag",
    "log_claim_amount",
    "claim_zscore_region",
    "claim_above_region_p95",
    "provider_claim_deviation",
    "anomaly_score_proxy",
]
