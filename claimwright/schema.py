"""Claim schema, column lists and the domain constants of the pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field names, domains, codes and thresholds define the results
# and must stay exactly as they are.
# ---------------------------------------------------------------------------

CLAIM_SCHEMA = (
    T.StructType()
    .add("claim_id", T.StringType())
    .add("patient_id", T.StringType())
    .add("age", T.IntegerType())
    .add("sex", T.StringType())
    .add("bmi", T.DoubleType())
    .add("children", T.IntegerType())
    .add("smoker", T.BooleanType())
    .add("region", T.StringType())
    .add("claim_amount", T.DoubleType())
    .add("procedure_code", T.StringType())
    .add("procedure_description", T.StringType())
    .add("provider_id", T.StringType())
    .add("submission_timestamp", T.StringType())
    .add("days_since_last_claim", T.IntegerType())
    .add("diagnosis_code", T.StringType())
    .add("is_fraud", T.BooleanType())
)

REGIONS = ["northeast", "northwest", "southeast", "southwest"]
SEXES = ["male", "female"]
UNKNOWN = "unknown"

AGE_RANGE = (1, 115)
BMI_RANGE = (10.0, 70.0)
AMOUNT_CAP = 500000.0

PROCEDURES = {
    "99213": "office_visit_moderate",
    "99214": "office_visit_complex",
    "71046": "chest_xray",
    "93000": "ecg",
    "80053": "metabolic_panel",
    "36415": "blood_draw",
    "99395": "preventive_exam",
    "27447": "knee_replacement",
    "43239": "gastric_bypass",
    "70553": "brain_mri",
}
HIGH_RISK_PROCEDURES = ["27447", "43239", "70553"]
MEDIUM_RISK_PROCEDURES = ["93000", "71046", "80053"]
IMPLAUSIBLE_WHEN_YOUNG = ["27447", "43239"]
KNEE_REPLACEMENT = "27447"
WATCHED_PROVIDER = "PRV9999"

# Order of the model's feature vector.
FEATURES = [
    "age",
    "bmi",
    "children",
    "claim_amount",
    "days_since_last_claim",
    "charge_per_age",
    "log_claim_amount",
    "smoker_obese_flag",
    "high_value_claim",
    "rapid_resubmission",
    "young_high_procedure_flag",
    "provider_high_volume_flag",
    "claim_above_region_p95",
    "anomaly_score_proxy",
    "provider_claim_deviation",
    "claim_zscore_region",
    "sex_idx",
    "region_idx",
    "bmi_cat_idx",
    "age_group_idx",
    "procedure_risk_idx",
]

# category column -> index column
CATEGORY_INDEX = {
    "sex": "sex_idx",
    "region": "region_idx",
    "bmi_category": "bmi_cat_idx",
    "age_group": "age_group_idx",
    "procedure_risk": "procedure_risk_idx",
}

# ---------------------------------------------------------------------------
# Derived schemas
# ---------------------------------------------------------------------------

# A normalised region is one of these, so per-region tables have at most five rows.
REGION_DOMAIN = [*REGIONS, UNKNOWN]

# What a Kafka source yields; captured topics are stored with the same columns.
MESSAGE_SCHEMA = (
    T.StructType()
    .add("key", T.BinaryType())
    .add("value", T.BinaryType())
    .add("topic", T.StringType())
    .add("partition", T.IntegerType())
    .add("offset", T.LongType())
    .add("timestamp", T.TimestampType())
)

# The raw claims table. `region` is the partition column and so comes last on reading; naming it here
# keeps Spark from inferring its type out of the directory names.
RAW_SCHEMA = T.StructType(
    [f for f in CLAIM_SCHEMA if f.name not in ("submission_timestamp", "region")]
    + [
        T.StructField("kafka_ts", T.TimestampType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("submission_ts", T.TimestampType()),
        T.StructField("ingestion_ts", T.TimestampType()),
        T.StructField("region", T.StringType()),
    ]
)
