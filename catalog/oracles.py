"""The registered queries once more, as DuckDB SQL over the given tables.

Written apart from the Spark code: only the list of feature names and report templates are shared."""

from __future__ import annotations

from claimwright.schema import FEATURES


def r(expr: str, digits: int) -> str:
    """Half-up rounding on the shortest decimal form of a double, as Spark's `round` does it."""
    return f"round(({expr})::varchar::decimal(38,17), {digits})::double"


def pct(part: str, whole: str = "count(*)") -> str:
    return r(f"({part})::double * 100 / {whole}", 2)


LINES = """
lines AS (
  SELECT * FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""

SOURCE = LINES + """,
bare AS (
  SELECT
    'C' || l_orderkey || '-' || l_linenumber AS claim_id,
    'P' || o_custkey AS patient_id,
    (CASE l_orderkey % 97 WHEN 0 THEN 0 WHEN 1 THEN 120 ELSE 18 + (o_custkey * 7) % 70 END)::int AS age,
    CASE o_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN ' Female ' ELSE 'X' END AS sex,
    (CASE WHEN l_orderkey % 89 = 0 THEN 75 ELSE 15 END)::double + ((l_partkey * 37) % 400)::double / 10::double AS bmi,
    (o_custkey % 5)::int AS children,
    o_custkey % 5 = 0 AS smoker,
    CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE
      CASE n_regionkey WHEN 0 THEN ' Northeast ' WHEN 1 THEN 'northwest' WHEN 2 THEN 'SOUTHEAST'
                       WHEN 3 THEN 'southwest' WHEN 4 THEN 'overseas' END END AS region,
    (CASE l_orderkey % 101 WHEN 0 THEN 40 WHEN 1 THEN -1 ELSE 1 END)::double
      * l_extendedprice * (1::double - l_discount) / 3::double AS claim_amount,
    ['99213','99214','71046','93000','80053','36415','99395','27447','43239','70553'][l_partkey % 10 + 1]
      AS procedure_code,
    ['office_visit_moderate','office_visit_complex','chest_xray','ecg','metabolic_panel','blood_draw',
     'preventive_exam','knee_replacement','gastric_bypass','brain_mri'][l_partkey % 10 + 1] AS procedure_description,
    CASE WHEN l_suppkey % 25 = 0 THEN 'PRV9999' ELSE 'PRV' || (1000 + l_suppkey) END AS provider_id,
    CASE WHEN l_orderkey % 79 = 0 THEN 'bad-ts' ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END
      AS submission_timestamp,
    ((l_orderkey * 13 + l_linenumber * 31) % 365)::int AS days_since_last_claim,
    CASE WHEN l_partkey % 50 = 0 THEN 'Z99.89' ELSE 'D' || (l_partkey % 90 + 10) END AS diagnosis_code,
    l_shipdate AS kafka_ts,
    l_orderkey * 8 + l_linenumber AS kafka_offset,
    (l_suppkey % 4)::int AS kafka_partition
  FROM lines
),
source AS (
  SELECT *,
    claim_amount > 4 * ((1800 + age * 55::double + bmi * 35) * (CASE WHEN smoker THEN 2.8::double ELSE 1 END)
                        + children * 450::double)
    OR (days_since_last_claim <= 7 AND claim_amount > 15000)
    OR (age < 30 AND procedure_code IN ('27447', '43239'))
    OR provider_id = 'PRV9999' AS is_fraud
  FROM bare
)"""

CLEAN = SOURCE + """,
clean AS (
  SELECT * REPLACE (
      CASE WHEN lower(trim(sex)) IN ('male', 'female') THEN lower(trim(sex)) ELSE 'unknown' END AS sex,
      CASE WHEN lower(trim(region)) IN ('northeast', 'northwest', 'southeast', 'southwest')
           THEN lower(trim(region)) ELSE 'unknown' END AS region,
      least(claim_amount, 500000::double) AS claim_amount),
    try_cast(submission_timestamp AS timestamp) AS submission_ts,
    timestamp '2024-01-01 00:00:00' AS ingestion_ts
  FROM source
  WHERE claim_id IS NOT NULL AND patient_id IS NOT NULL AND region IS NOT NULL
    AND age BETWEEN 1 AND 115 AND bmi BETWEEN 10 AND 70 AND claim_amount > 0
)"""

CLAIMS = CLEAN + """,
claims AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (
    PARTITION BY claim_id
    ORDER BY claim_amount DESC, bmi, provider_id, submission_timestamp, procedure_code, diagnosis_code) = 1
)"""

STATS = CLAIMS + """,
providers AS (
  SELECT provider_id, count(*) AS provider_total_claims, avg(claim_amount) AS provider_avg_claim,
         max(claim_amount) AS provider_max_claim, avg(is_fraud::int::double) AS provider_fraud_rate
  FROM claims GROUP BY provider_id
),
regions AS (
  SELECT region, avg(claim_amount) AS region_avg_claim, stddev_samp(claim_amount) AS region_stddev_claim,
         quantile_disc(claim_amount, 0.95) AS region_p95_claim
  FROM claims GROUP BY region
)"""

FEATURE_ROWS = STATS + f""",
joined AS (
  SELECT * FROM claims LEFT JOIN providers USING (provider_id) LEFT JOIN regions USING (region)
),
flagged AS (
  SELECT *,
    {r('claim_amount / (age::double + 1)', 4)} AS charge_per_age,
    CASE WHEN bmi < 18.5 THEN 'underweight' WHEN bmi < 25 THEN 'normal' WHEN bmi < 30 THEN 'overweight'
         ELSE 'obese' END AS bmi_category,
    CASE WHEN age < 30 THEN 'young' WHEN age < 50 THEN 'middle' WHEN age < 65 THEN 'senior'
         ELSE 'elderly' END AS age_group,
    CASE WHEN procedure_code IN ('27447', '43239', '70553') THEN 'high'
         WHEN procedure_code IN ('93000', '71046', '80053') THEN 'medium' ELSE 'low' END AS procedure_risk,
    (smoker AND bmi >= 30)::int AS smoker_obese_flag,
    (claim_amount > 20000)::int AS high_value_claim,
    (days_since_last_claim <= 7)::int AS rapid_resubmission,
    (age < 30 AND procedure_code = '27447')::int AS young_high_procedure_flag,
    (provider_id = 'PRV9999')::int AS provider_high_volume_flag,
    ln(1 + claim_amount) AS log_claim_amount,
    CASE WHEN region_stddev_claim > 0 THEN (claim_amount - region_avg_claim) / region_stddev_claim
         ELSE 0::double END AS claim_zscore_region,
    (claim_amount > region_p95_claim)::int AS claim_above_region_p95,
    {r('claim_amount / (provider_avg_claim + 1)', 4)} AS provider_claim_deviation
  FROM joined
),
features AS (
  SELECT *,
    (2 * high_value_claim + smoker_obese_flag + 3 * rapid_resubmission + 2 * young_high_procedure_flag
     + 2 * provider_high_volume_flag + claim_above_region_p95)::double AS anomaly_score_proxy,
    is_fraud::int AS label
  FROM flagged
)"""

CATEGORIES = ["sex", "region", "bmi_category", "age_group", "procedure_risk"]
INDEXES = ["sex_idx", "region_idx", "bmi_cat_idx", "age_group_idx", "procedure_risk_idx"]

INDEX_ROWS = FEATURE_ROWS + ",\ncategories AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS category, count(*) AS n FROM features GROUP BY {c}" for c in CATEGORIES
) + """),
idx AS (
  SELECT column_name, category, n,
         (row_number() OVER (PARTITION BY column_name ORDER BY n DESC, category) - 1)::double AS idx
  FROM categories
),
indexed AS (
  SELECT features.*, """ + ", ".join(f"i{k}.idx AS {name}" for k, name in enumerate(INDEXES)) + """
  FROM features """ + " ".join(
    f"LEFT JOIN idx i{k} ON i{k}.column_name = '{c}' AND i{k}.category = features.{c}"
    for k, c in enumerate(CATEGORIES)
) + ")"

PREDICTIONS = FEATURE_ROWS + """,
predictions AS (
  SELECT *, (anomaly_score_proxy >= 4)::int::double AS prediction,
    CASE WHEN ('0x' || substr(md5(claim_id), 1, 8))::bigint % 10 < 8 THEN 'train' ELSE 'test' END AS split
  FROM features
)"""


def on(ctes: str, select: str) -> str:
    select = select.strip()
    # a select that starts with a comma adds common tables of its own
    return f"WITH {ctes.strip()}{select}" if select.startswith(",") else f"WITH {ctes.strip()}\n{select}"


def weighted_metrics(by: str = "") -> str:
    """Class-weighted metrics of `predictions`, per `by` if given."""
    group, lead = (f"GROUP BY {by}", f"{by}, ") if by else ("", "")
    match = f"AND p.{by} = a.{by}" if by else ""
    return f"""
actual AS (SELECT {lead}label AS cls, count(*) AS n, sum((prediction = label)::int) AS hits
           FROM predictions GROUP BY {lead}label),
predicted AS (SELECT {lead}prediction AS cls, count(*) AS n FROM predictions GROUP BY {lead}prediction),
per_class AS (
  SELECT {'a.' + by + ',' if by else ''} a.n::double AS n, a.hits, a.hits / a.n::double AS rec,
         coalesce(a.hits / p.n::double, 0) AS prec
  FROM actual a LEFT JOIN predicted p ON p.cls = a.cls {match}
),
metrics AS (
  SELECT {lead}
    sum(n * CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END) / sum(n) AS f1,
    sum(n * prec) / sum(n) AS "precision", sum(n * rec) / sum(n) AS recall, sum(hits) / sum(n) AS accuracy
  FROM per_class {group}
)"""


YEARLY = PREDICTIONS.replace(
    "SELECT *, (anomaly_score_proxy >= 4)", "SELECT *, year(submission_ts) AS yr, (anomaly_score_proxy >= 4)"
).replace("FROM features\n)", "FROM features WHERE submission_ts IS NOT NULL\n)") + "," + weighted_metrics("yr")

STAMP = "'%Y-%m-%d %H:%M:%S'"
CLAIM_FIELDS = """claim_id, patient_id, age, sex, bmi, children, smoker, region, claim_amount, procedure_code,
  procedure_description, provider_id, submission_timestamp, days_since_last_claim, diagnosis_code, is_fraud"""
STABLE = "claim_id, patient_id, age, sex, children, smoker, region, days_since_last_claim"

ORACLES: dict[str, str] = {}

# --- sources and sinks ----------------------------------------------------------------------------------

ORACLES["stream_source_files"] = on(SOURCE, """
SELECT 'health_insurance_claims' AS topic, kafka_partition AS "partition", count(*) AS messages,
       max(kafka_offset) AS last_offset
FROM source GROUP BY kafka_partition""")

_bad = "kafka_offset % 53 = 0"


def _decoded(column: str) -> str:
    lost = f"{_bad} OR kafka_offset % 59 = 0" if column == "age" else _bad
    kind = {"age": "double", "children": "double", "days_since_last_claim": "double",
            "smoker": "varchar", "is_fraud": "varchar"}.get(column)
    return f"CASE WHEN {lost} THEN NULL ELSE {column}{'::' + kind if kind else ''} END AS {column}"


ORACLES["decode_json_claims"] = on(SOURCE, "SELECT " + ", ".join(
    _decoded(c) for c in CLAIM_FIELDS.replace("\n", "").replace(" ", "").split(",")
) + f", strftime(kafka_ts, {STAMP}) AS kafka_ts, kafka_offset, kafka_partition FROM source")

ORACLES["decode_event_props"] = "SELECT event_id, json_extract_string(props, '$.k')::int AS k FROM events"
ORACLES["encode_roundtrip"] = on(SOURCE, f"SELECT {CLAIM_FIELDS} FROM source")
ORACLES["scan_raw_claims"] = on(CLAIMS, f"""
SELECT {CLAIM_FIELDS.replace("submission_timestamp, ", "")}, kafka_offset, kafka_partition,
  strftime(kafka_ts, {STAMP}) AS kafka_ts, strftime(submission_ts, {STAMP}) AS submission_ts,
  strftime(ingestion_ts, {STAMP}) AS ingestion_ts
FROM claims""")
ORACLES["map_insurance_csv"] = on(CLAIMS, "SELECT age, sex, bmi, children, smoker, region, claim_amount FROM claims")
ORACLES["map_cms_claims"] = on(LINES, """,
cms AS (
  SELECT *, date '1930-01-01' + ((o_custkey * 7919) % 20000)::int AS born,
    ['99213','99214','71046','93000','80053','36415','99395','27447','43239','70553',NULL,NULL][l_partkey % 12 + 1]
      AS code,
    ['office_visit_moderate','office_visit_complex','chest_xray','ecg','metabolic_panel','blood_draw',
     'preventive_exam','knee_replacement','gastric_bypass','brain_mri',NULL,NULL][l_partkey % 12 + 1] AS description
  FROM lines
)
SELECT 'C' || l_orderkey || '-' || l_linenumber AS claim_id, 'P' || o_custkey AS patient_id,
  datesub('year', born, l_shipdate::date)::int AS age,
  CASE o_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS sex,
  l_extendedprice AS claim_amount, code AS procedure_code, description AS procedure_description,
  'PRV' || (l_suppkey + 1000000000) AS provider_id,
  strftime(l_shipdate, '%Y-%m-%dT00:00:00') AS submission_timestamp,
  'V' || (l_partkey % 90 + 10) AS diagnosis_code
FROM cms""")

ORACLES["cms_rule_labels"] = on(LINES, f""",
cms AS (
  SELECT 'C' || l_orderkey || '-' || l_linenumber AS claim_id, 'PRV' || (l_suppkey + 1000000000) AS provider_id,
    l_extendedprice AS claim_amount, datesub('year', date '1930-01-01' + ((o_custkey * 7919) % 20000)::int,
    l_shipdate::date) AS age,
    ['99213','99214','71046','93000','80053','36415','99395','27447','43239','70553',NULL,NULL][l_partkey % 12 + 1]
      AS code
  FROM lines
),
averages AS (SELECT provider_id, avg(claim_amount) AS mean FROM cms GROUP BY provider_id)
SELECT claim_id, provider_id, claim_amount, NULL::varchar AS bmi,
  coalesce(age < 30 AND code IN ('27447', '43239'), false) OR {r('claim_amount / (mean + 1)', 4)} > 4.5 AS is_fraud
FROM cms JOIN averages USING (provider_id)""")
ORACLES["insurance_claims"] = on(CLAIMS, """
SELECT age, sex, bmi, children, smoker, region, claim_amount, NULL::varchar AS days_since_last_claim FROM claims""")
ORACLES["feature_table_roundtrip"] = on(INDEX_ROWS, """
SELECT claim_id, provider_id, charge_per_age, bmi_category, anomaly_score_proxy, sex_idx,
       anomaly_score_proxy AS score_by_path
FROM indexed""")
ORACLES["confusion_matrix_pivot"] = on(PREDICTIONS, """
SELECT CASE label WHEN 1 THEN 'Actual_Fraud' ELSE 'Actual_Normal' END AS actual,
  count(*) FILTER (WHERE prediction = 0) AS Predicted_Normal, count(*) FILTER (WHERE prediction = 1) AS Predicted_Fraud
FROM predictions GROUP BY label""")


def _latest_value(metric: str, less: float = 0) -> str:
    if metric == "auc_roc":
        return f"""(SELECT {r("(avg(prediction) FILTER (WHERE label = 1) + avg(1 - prediction) FILTER (WHERE label = 0))"
                             " / 2::double", 4)} - {less}::double
                    FROM predictions WHERE yr = (SELECT max(yr) FROM predictions))"""
    return f"(SELECT arg_max({r(metric, 4)}, yr) - {less}::double FROM metrics)"


def _latest(metric: str, less: float = 0) -> str:
    return f"coalesce({_latest_value(metric, less)}::varchar, 'N/A')"


_report = [
    ("header", "'Automated Retraining Report'"),
    ("header", "'Run timestamp : 2024-01-08T02:00:00 UTC'"),
    ("header", "'Run ID        : weekly'"),
    ("header", "'Input files   : N/A'"),
    ("gbt", "'GBT Classifier Results'"),
    ("gbt", "'  AUC-ROC    : ' || " + _latest("auc_roc")),
    ("gbt", "'  AUC-PR     : N/A'"),
    ("gbt", "'  F1 Score   : ' || " + _latest("f1")),
    ("gbt", "'  Precision  : ' || " + _latest('"precision"')),
    ("gbt", "'  Recall     : ' || " + _latest("recall")),
    ("gbt", "'  Accuracy   : ' || " + _latest("accuracy")),
    ("logistic_regression", "'Logistic Regression Baseline'"),
    ("logistic_regression", "'  AUC-ROC    : ' || " + _latest("auc_roc", 0.0625)),
    ("logistic_regression", "'  F1 Score   : ' || " + _latest("f1", 0.0625)),
    ("status", "'Status: Retraining completed successfully.'"),
]
ORACLES["retraining_report"] = on(YEARLY, " UNION ALL ".join(
    f"SELECT '{section}' AS section, {n}::int AS line_no, {line} AS text" for n, (section, line) in enumerate(_report, 1)
))
ORACLES["latest_model_metric"] = on(YEARLY, f"SELECT {_latest_value('auc_roc')} AS metric_value")

# --- filters, joins, statistics -------------------------------------------------------------------------

ORACLES["validate_claims"] = on(CLEAN, f"""
SELECT {CLAIM_FIELDS}, strftime(submission_ts, {STAMP}) AS submission_ts,
  strftime(ingestion_ts, {STAMP}) AS ingestion_ts
FROM clean""")
ORACLES["rejected_claims"] = on(SOURCE, "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{name}' AS reason, count(*) AS rejected_rows FROM source WHERE NOT coalesce({ok}, false)"
    for name, ok in (
        ("claim_id", "claim_id IS NOT NULL"), ("patient_id", "patient_id IS NOT NULL"),
        ("age", "age BETWEEN 1 AND 115"), ("bmi", "bmi BETWEEN 10 AND 70"),
        ("claim_amount", "claim_amount > 0"), ("region", "region IS NOT NULL"),
    )
) + ") WHERE rejected_rows > 0")
ORACLES["fraud_only_count"] = on(CLAIMS, "SELECT count(*) AS fraud_claims FROM claims WHERE is_fraud")
ORACLES["labelled_claims"] = on(CLAIMS, "SELECT claim_id, is_fraud, is_fraud::int AS label FROM claims")
ORACLES["features_filled"] = on(FEATURE_ROWS, """
SELECT claim_id,
  CASE WHEN days_since_last_claim % 7 = 0 THEN 0::double ELSE bmi END AS bmi,
  CASE WHEN days_since_last_claim % 5 = 0 THEN 0::double ELSE charge_per_age END AS charge_per_age,
  CASE WHEN days_since_last_claim % 3 = 0 THEN 0 ELSE age END AS age
FROM features""")

_provider_values = ", ".join(
    f"{r(c, 4)} AS {c}" for c in ("provider_avg_claim", "provider_max_claim", "provider_fraud_rate"))
_region_values = ", ".join(
    f"{r(c, 4)} AS {c}" for c in ("region_avg_claim", "region_stddev_claim", "region_p95_claim"))
ORACLES["claims_with_provider_stats"] = on(STATS, f"""
SELECT claim_id, provider_id, provider_total_claims, {_provider_values}
FROM claims LEFT JOIN providers USING (provider_id)""")
ORACLES["claims_with_provider_stats_shuffled"] = ORACLES["claims_with_provider_stats"]
ORACLES["claims_with_region_stats"] = on(CLAIMS, f""",
moved AS (
  SELECT * REPLACE (CASE WHEN days_since_last_claim % 11 = 0 THEN 'midwest' ELSE region END AS region) FROM claims
),
regions AS (
  SELECT region, avg(claim_amount) AS region_avg_claim, stddev_samp(claim_amount) AS region_stddev_claim,
         quantile_disc(claim_amount, 0.95) AS region_p95_claim
  FROM moved GROUP BY region
)
SELECT claim_id, region, {_region_values} FROM moved LEFT JOIN regions USING (region)""")
ORACLES["provider_stats"] = on(STATS, f"SELECT provider_id, provider_total_claims, {_provider_values} FROM providers")
ORACLES["region_stats"] = on(STATS, f"SELECT region, {_region_values} FROM regions")
ORACLES["confusion_matrix"] = on(PREDICTIONS, """
SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn
FROM predictions""")
ORACLES["dataset_summary"] = on(CLAIMS, f"""
SELECT count(*) AS total, count(*) FILTER (WHERE is_fraud) AS fraud_count,
  {pct('count(*) FILTER (WHERE is_fraud)')} AS fraud_pct
FROM claims""")
ORACLES["mean_abs_by_feature"] = on(INDEX_ROWS, " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {r(f'avg(abs({f}))', 6)} AS mean_abs FROM indexed" for f in FEATURES))
ORACLES["dedup_claims"] = on(CLAIMS, f"SELECT {CLAIM_FIELDS} FROM claims")
ORACLES["category_index"] = on(INDEX_ROWS, "SELECT column_name, category, n, idx FROM idx")
ORACLES["indexed_categoricals"] = on(INDEX_ROWS, "SELECT claim_id, " + ", ".join(INDEXES) + " FROM indexed")
ORACLES["union_by_class"] = on(CLAIMS, "SELECT claim_id, is_fraud FROM claims")

# --- sampling -------------------------------------------------------------------------------------------

def _uniform(seed: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || claim_id), 1, 12))::bigint / 281474976710656::double"


ORACLES["oversample_poisson"] = on(CLAIMS, f""",
ratio AS (
  SELECT least(count(*) FILTER (WHERE NOT is_fraud)::double / count(*) FILTER (WHERE is_fraud), 5::double) AS mean
  FROM claims
),
steps AS (
  SELECT k, sum(exp(-mean) * mean ** k / factorial(k::int)) OVER (ORDER BY k) AS upto
  FROM ratio, (SELECT unnest(range(33))::int AS k)
),
drawn AS (
  SELECT claim_id, is_fraud, CASE WHEN is_fraud THEN (SELECT count(*) FROM steps WHERE {_uniform(42)} >= upto)
    ELSE 1 END AS n
  FROM claims WHERE is_fraud IS NOT NULL
)
SELECT claim_id, is_fraud FROM (SELECT claim_id, is_fraud, unnest(range(n)) FROM drawn)""")
ORACLES["cv_folds"] = on(CLAIMS, f"""
SELECT claim_id, floor({_uniform(43)} * 3)::int AS fold FROM claims
WHERE ('0x' || substr(md5(claim_id), 1, 8))::bigint % 10 < 8""")
ORACLES["out_of_fold_scores"] = on(CLAIMS, f""",
rows AS (
  SELECT claim_id, is_fraud, floor({_uniform(43)} * 3)::int AS fold FROM claims
  WHERE ('0x' || substr(md5(claim_id), 1, 8))::bigint % 10 < 8)
SELECT combination::int AS combination, fold, count(*) AS n_rows, count(DISTINCT claim_id) AS n_claims,
  sum(is_fraud::int)::bigint AS n_fraud
FROM rows, range(4) AS c(combination) GROUP BY ALL""")
ORACLES["oversample_replicated"] = on(CLAIMS, """,
ratio AS (
  SELECT greatest(floor(least(count(*) FILTER (WHERE NOT is_fraud)::double / count(*) FILTER (WHERE is_fraud), 5)), 1)
         ::bigint AS k
  FROM claims
)
SELECT claim_id, is_fraud
FROM (SELECT claim_id, is_fraud, unnest(range(CASE WHEN is_fraud THEN (SELECT k FROM ratio) ELSE 1 END)) FROM claims)
""")
ORACLES["hash_split"] = on(CLAIMS, """
SELECT claim_id,
  CASE WHEN ('0x' || substr(md5(claim_id), 1, 8))::bigint % 10 < 8 THEN 'train' ELSE 'test' END AS split
FROM claims""")
ORACLES["balanced_sample"] = on(FEATURE_ROWS, """
SELECT claim_id, is_fraud, claim_amount, anomaly_score_proxy FROM features
QUALIFY row_number() OVER (PARTITION BY is_fraud ORDER BY md5(claim_id), claim_id) <= 4000""")
ORACLES["stratified_split"] = on(FEATURE_ROWS + """,
relabelled AS (
  SELECT claim_id, CASE WHEN days_since_last_claim % 13 = 0 THEN 2 WHEN days_since_last_claim % 17 = 0 THEN NULL
    ELSE label END::double AS label
  FROM features
)""", """
SELECT claim_id, label,
  CASE WHEN 10 * row_number() OVER (PARTITION BY label ORDER BY md5(claim_id))
            < 8 * count(*) OVER (PARTITION BY label) + 10 THEN 'train' ELSE 'test' END AS split
FROM relabelled""")

# --- features, labels -----------------------------------------------------------------------------------

ORACLES["engineered_features"] = on(FEATURE_ROWS, f"""
SELECT claim_id, charge_per_age, bmi_category, age_group, procedure_risk, smoker_obese_flag, high_value_claim,
  rapid_resubmission, young_high_procedure_flag, provider_high_volume_flag,
  {r('log_claim_amount', 6)} AS log_claim_amount, {r('claim_zscore_region', 6)} AS claim_zscore_region,
  claim_above_region_p95, provider_claim_deviation, anomaly_score_proxy
FROM features""")
_expected = """(1800 + age * 55::double + bmi * 35) * (CASE WHEN smoker THEN 2.8::double ELSE 1 END)
  + children * 450::double"""
ORACLES["expected_charge"] = on(CLAIMS, f"SELECT claim_id, {r(_expected, 4)} AS expected_charge FROM claims")
_rules = {
    "rule_inflation": f"claim_amount > 4 * ({_expected})",
    "rule_rapid_high": "days_since_last_claim <= 7 AND claim_amount > 15000",
    "rule_implausible_procedure": "age < 30 AND procedure_code IN ('27447', '43239')",
    "rule_provider": "provider_id = 'PRV9999' OR provider_claim_deviation > 4.5",
}
_any = " OR ".join(f"({rule})" for rule in _rules.values())
ORACLES["fraud_rule_flags"] = on(FEATURE_ROWS, "SELECT claim_id, " + ", ".join(
    f"{rule} AS {name}" for name, rule in _rules.items()) + " FROM features")
ORACLES["rule_labels"] = on(FEATURE_ROWS, f"SELECT claim_id, {_any} AS rule_label FROM features")
ORACLES["fraud_rate_check"] = on(FEATURE_ROWS, f"""
SELECT fraud_pct, fraud_pct BETWEEN 7 AND 9 AS as_expected
FROM (SELECT {pct(f'count(*) FILTER (WHERE {_any})')} AS fraud_pct FROM features)""")
ORACLES["fraud_signatures"] = on(CLAIMS, """
SELECT claim_id, concat_ws(',',
  CASE WHEN bmi BETWEEN 42 AND 56 AND diagnosis_code = 'Z99.89' THEN 'inflated_obese' END,
  CASE WHEN days_since_last_claim BETWEEN 0 AND 3 AND claim_amount BETWEEN 18000 AND 52000
        AND procedure_code IN ('27447', '43239', '70553') THEN 'rapid_expensive' END,
  CASE WHEN age BETWEEN 19 AND 24 AND procedure_code = '27447' AND claim_amount BETWEEN 28000 AND 65000
        AND bmi BETWEEN 22 AND 27 THEN 'young_knee' END,
  CASE WHEN provider_id = 'PRV9999' AND smoker AND claim_amount BETWEEN 22000 AND 48000
        AND days_since_last_claim BETWEEN 1 AND 5 THEN 'watched_provider' END) AS signatures
FROM claims""")

# --- reports, panels, benchmark workloads ---------------------------------------------------------------

_n, _fraud = "count(*)", "count(*) FILTER (WHERE is_fraud)"
REPORT_SQL = {
    "region_fraud_patterns": f"""
SELECT region, {_n} AS total_claims, {_fraud} AS fraud_claims, {pct(_fraud)} AS fraud_rate_pct,
  {r('avg(claim_amount)', 2)} AS avg_claim_amount, {r('max(claim_amount)', 2)} AS max_claim_amount,
  {r('avg(anomaly_score_proxy)', 3)} AS avg_risk_score
FROM features GROUP BY ALL ORDER BY fraud_rate_pct DESC, region""",
    "top_risk_feature_comparison": "SELECT " + ", ".join(
        f"{r(f'avg({col}) FILTER (WHERE {cond})', digits)} AS {name}_{kind}"
        for col, name, digits in (("anomaly_score_proxy", "avg_risk_score", 3), ("charge_per_age", "avg_charge_per_age", 2),
                                  ("log_claim_amount", "avg_log_claim", 4))
        for kind, cond in (("fraud", "is_fraud"), ("normal", "NOT is_fraud"))
    ) + """, count(*) FILTER (WHERE is_fraud AND smoker_obese_flag = 1) AS fraud_smoker_obese,
  count(*) FILTER (WHERE is_fraud AND rapid_resubmission = 1) AS fraud_rapid_resubmit
FROM features""",
    "claim_distribution_bmi_age": f"""
SELECT bmi_category, age_group, {_n} AS claim_count, {r('avg(claim_amount)', 2)} AS avg_claim,
  {r('min(claim_amount)', 2)} AS min_claim, {r('max(claim_amount)', 2)} AS max_claim,
  {_fraud} AS fraud_count, {pct(_fraud)} AS fraud_pct
FROM features GROUP BY ALL ORDER BY avg_claim DESC, bmi_category, age_group""",
    "suspicious_high_value_claims": f"""
SELECT claim_id, patient_id, age, {r('bmi', 1)} AS bmi, {r('features.claim_amount', 2)} AS claim_amount,
  procedure_code, provider_id, region, days_since_last_claim, {r('anomaly_score_proxy', 2)} AS risk_score, is_fraud
FROM features
WHERE features.claim_amount > 25000
  AND 1 IN (rapid_resubmission, young_high_procedure_flag, provider_high_volume_flag)
ORDER BY {r('features.claim_amount', 2)} DESC, claim_id LIMIT 50""",
    "provider_anomaly_summary": f"""
SELECT provider_id, {_n} AS total_claims, {_fraud} AS confirmed_fraud, {pct(_fraud)} AS fraud_rate_pct,
  {r('avg(claim_amount)', 2)} AS avg_claim, {r('max(claim_amount)', 2)} AS max_claim,
  {r('avg(anomaly_score_proxy)', 3)} AS avg_risk_score,
  sum(rapid_resubmission)::bigint AS rapid_resubmission_count
FROM features GROUP BY provider_id HAVING count(*) > 3
ORDER BY confirmed_fraud DESC, avg_risk_score DESC, provider_id LIMIT 25""",
    "explainability_flagged_claims": f"""
SELECT claim_id, age, bmi_category, age_group, procedure_risk, region,
  {r('features.claim_amount', 2)} AS claim_amount, {r('anomaly_score_proxy', 2)} AS risk_score, smoker_obese_flag,
  rapid_resubmission, young_high_procedure_flag, provider_high_volume_flag, claim_above_region_p95, is_fraud
FROM features WHERE anomaly_score_proxy >= 4
ORDER BY anomaly_score_proxy DESC, {r('features.claim_amount', 2)} DESC, claim_id LIMIT 100""",
    "procedure_code_fraud_analysis": f"""
SELECT procedure_code, procedure_description, procedure_risk, {_n} AS total_claims, {_fraud} AS fraud_claims,
  {pct(_fraud)} AS fraud_rate_pct, {r('avg(claim_amount)', 2)} AS avg_claim_amount
FROM features GROUP BY ALL ORDER BY fraud_rate_pct DESC, procedure_code, procedure_description""",
    "total_claims": "SELECT count(*) AS total_claims FROM features",
    "overall_fraud_rate": f"SELECT {pct(_fraud)} AS fraud_rate FROM features",
    "avg_fraud_claim": f"SELECT {r('avg(claim_amount)', 2)} AS avg_fraud_claim FROM features WHERE is_fraud",
    "fraud_rate_by_region": f"""
SELECT region, {pct(_fraud)} AS fraud_rate_pct FROM features GROUP BY region ORDER BY fraud_rate_pct DESC, region""",
    "top_suspicious_claims": f"""
SELECT claim_id, age, region, procedure_code, {r('features.claim_amount', 2)} AS claim_amount,
  {r('anomaly_score_proxy', 1)} AS risk_score, is_fraud
FROM features WHERE features.claim_amount > 20000
ORDER BY {r('features.claim_amount', 2)} DESC, claim_id LIMIT 20""",
}
for _name, _sql in REPORT_SQL.items():
    ORACLES[_name] = on(FEATURE_ROWS, _sql)
ORACLES["report_csv_roundtrip"] = ORACLES["region_fraud_patterns"]
ORACLES["procedure_report_written"] = on(FEATURE_ROWS, f"""
SELECT *, row_number() OVER (ORDER BY fraud_rate_pct DESC, procedure_code, procedure_description) AS place
FROM ({REPORT_SQL['procedure_code_fraud_analysis']})""")
ORACLES["run_all_reports"] = on(FEATURE_ROWS, " UNION ALL ".join(
    f"SELECT '{name}' AS report, count(*) AS row_count FROM ({REPORT_SQL[name]})"
    for name in list(REPORT_SQL)[:7]))


def _band(value: str, *steps: tuple[float, str]) -> str:
    whens = " ".join(f"WHEN {value} >= {bound} THEN '{name}'" for bound, name in reversed(steps))
    return f"CASE {whens} ELSE 'green' END"


ORACLES["threshold_status"] = on(YEARLY, f""",
v AS (
  SELECT count(*)::double AS a, {pct(_fraud)} AS b, {r('avg(claim_amount) FILTER (WHERE is_fraud)', 2)} AS c,
    {r('avg(anomaly_score_proxy)', 1)} AS d
  FROM features
)
SELECT 'total_claims' AS panel, a AS value, {_band('a', (40000, 'yellow'), (80000, 'red'))} AS band FROM v
UNION ALL SELECT 'fraud_rate', b, {_band('b', (6, 'orange'), (12, 'red'))} FROM v
UNION ALL SELECT 'avg_fraud_claim', c, {_band('c', (5000, 'orange'), (15000, 'red'))} FROM v
UNION ALL SELECT 'risk_score', d, {_band('d', (3, 'yellow'), (5, 'red'))} FROM v
UNION ALL SELECT 'auc_roc', e, {_band('e', (0.88, 'yellow'), (0.92, 'green'))} FROM (SELECT {_latest_value('auc_roc')}
  AS e)
""")

_hour = "date_trunc('hour', ts)"
_by_hour = f"""
SELECT strftime({_hour}, {STAMP}) AS time, count(*) FILTER (WHERE event_type <> 'error') AS normal_claims,
  count(*) FILTER (WHERE event_type = 'error') AS fraud_claims
FROM events WHERE {{where}} GROUP BY {_hour}"""
ORACLES["claims_over_time"] = _by_hour.format(where="ts > timestamp '2024-01-31' - INTERVAL 7 DAY")
ORACLES["bench_full_scan_count"] = on(CLAIMS, "SELECT count(*) AS num_records FROM claims")
ORACLES["bench_filter_project"] = on(CLAIMS, """
SELECT claim_id, claim_amount, region, is_fraud FROM claims WHERE claim_amount > 10000""")
ORACLES["bench_scaling"] = on(CLAIMS, f"""
SELECT fraction, region, count(*) AS cnt, {r('avg(claim_amount)', 4)} AS avg_amount
FROM claims, (SELECT unnest([0.25, 0.5, 1.0])::double AS fraction) WHERE {_uniform(42)} < fraction
GROUP BY fraction, region""")
ORACLES["bench_group_by"] = on(FEATURE_ROWS, f"""
SELECT region, bmi_category, count(*) AS cnt, {r('avg(claim_amount)', 4)} AS avg_claim, {_fraud} AS fraud_count
FROM features GROUP BY region, bmi_category""")
ORACLES["bench_join_provider_stats"] = on(STATS, """
SELECT count(*) AS num_records, count(provider_avg_claim) AS matched
FROM claims LEFT JOIN providers USING (provider_id)""")

# --- streaming ------------------------------------------------------------------------------------------

ORACLES["stream_ingest_claims"] = on(CLEAN, f"SELECT DISTINCT {STABLE}, true AS is_candidate FROM clean")
ORACLES["stream_dedup_global"] = on(CLEAN, "SELECT DISTINCT claim_id, patient_id FROM clean")


def batch_by_batch(last: int = 9, horizon: str = "400 days") -> str:
    """The stream's batches one after another: what of each is late, and what lands beside what landed before."""
    stages = [f"""
timed AS (
  SELECT *, coalesce(submission_ts, kafka_ts) AS event_ts FROM clean),
messages AS (
  SELECT least(greatest(year(kafka_ts) - 1992, 0), {last - 3})
    + CASE WHEN kafka_offset // 8 % 17 = 0 THEN 2 ELSE 0 END AS batch, * FROM source),
arrived AS (
  SELECT least(greatest(year(kafka_ts) - 1992, 0), {last - 3})
    + CASE WHEN kafka_offset // 8 % 17 = 0 THEN 2 ELSE 0 END AS batch, * FROM timed),
marks AS (
  SELECT b.batch, max(a.event_ts) FILTER (a.batch = b.batch) AS newest,
    max(a.event_ts) FILTER (a.batch < b.batch) - INTERVAL '{horizon}' AS watermark
  FROM (SELECT unnest(range({last})) AS batch) b, arrived a GROUP BY b.batch),
marked AS (
  SELECT a.*, watermark, watermark IS NOT NULL AND event_ts < watermark AS is_late FROM arrived a JOIN marks USING (batch)),
firsts AS (
  SELECT * FROM marked WHERE NOT is_late
  QUALIFY row_number() OVER (
    PARTITION BY batch, claim_id
    ORDER BY kafka_ts, kafka_partition, kafka_offset, claim_amount DESC, bmi, provider_id, submission_timestamp,
      procedure_code, diagnosis_code) = 1),
landed_0 AS (SELECT * FROM firsts WHERE batch = 0)"""]
    for k in range(1, last):
        before = " UNION ALL ".join(f"SELECT claim_id, event_ts FROM landed_{j}" for j in range(k))
        stages.append(f"""
landed_{k} AS (
  SELECT * FROM firsts f WHERE batch = {k} AND NOT EXISTS (
    SELECT 1 FROM ({before}) b WHERE b.claim_id = f.claim_id AND b.event_ts >= f.watermark))""")
    every = " UNION ALL ".join(f"SELECT * FROM landed_{k}" for k in range(last))
    return ",".join([CLEAN, *stages, f" landed AS ({every})"])


LANDED = batch_by_batch()
_time = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
_landed_columns = (f"claim_id, claim_amount, {_time.format('submission_ts')}, {_time.format('kafka_ts')}, kafka_offset, "
                   "region, batch::bigint AS batch")
_batch_counts = """, batches AS (
  SELECT b.batch::bigint AS batch,
    (SELECT count(*) FROM messages m WHERE m.batch = b.batch) AS received,
    (SELECT count(*) FROM marked k WHERE k.batch = b.batch) AS valid,
    (SELECT count(*) FROM marked k WHERE k.batch = b.batch AND is_late) AS late,
    (SELECT count(*) FROM landed l WHERE l.batch = b.batch) AS landed
  FROM marks b)"""
ORACLES["stream_dedup_watermark"] = on(LANDED, f"SELECT {_landed_columns} FROM landed")
ORACLES["stream_late_claims"] = on(LANDED, f"SELECT {_landed_columns} FROM marked WHERE is_late")
ORACLES["stream_batch_ledger"] = on(LANDED + _batch_counts, f"""
SELECT batch, received, received - valid AS rejected, late, valid - late - landed AS repeated, landed,
  {_time.format('newest')}, {_time.format('watermark')}
FROM batches JOIN marks USING (batch)""")
ORACLES["stream_restarted"] = on(LANDED + _batch_counts, """
SELECT sum(received)::bigint AS received, sum(received - valid)::bigint AS rejected, sum(late)::bigint AS late,
  sum(valid - late - landed)::bigint AS repeated, sum(landed)::bigint AS landed,
  (SELECT count(*) FROM landed) AS rows, (SELECT count(DISTINCT claim_id) FROM landed) AS claims,
  (SELECT count(DISTINCT batch) FROM landed) AS batches
FROM batches""")
# a window is closed when the watermark, an hour behind the newest event, has passed its end
ORACLES["stream_hourly_counts"] = _by_hour.format(
    where=f"{_hour} + INTERVAL 1 HOUR <= date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 1 HOUR")

# --- models, evaluation, explanation --------------------------------------------------------------------

ORACLES["threshold_rule_predictions"] = on(PREDICTIONS, "SELECT claim_id, label, prediction FROM predictions")
ORACLES["binary_auc"] = on(PREDICTIONS, f""",
steps AS (
  SELECT anomaly_score_proxy AS s, sum(label)::double AS p, sum(1 - label)::double AS n FROM predictions GROUP BY 1
),
curve AS (
  SELECT s, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS all_p, sum(n) OVER () AS all_n
  FROM steps WINDOW w AS (ORDER BY s DESC)
),
points AS (
  SELECT *, tp / (tp + fp) AS prec, lag(tp / (tp + fp)) OVER (ORDER BY s DESC) AS prev FROM curve
)
SELECT {r('sum(n * (tp - p / 2)) / max(all_p * all_n)', 4)} AS auc_roc,
  {r('sum(p / all_p * (prec + coalesce(prev, prec)) / 2)', 4)} AS auc_pr
FROM points""")
# areas by pairs of a fraud and a normal claim, ties half
ORACLES["auc_by_procedure"] = on(PREDICTIONS, f""",
steps AS (
  SELECT procedure_code, claim_amount AS s, sum(label)::double AS p, sum(1 - label)::double AS n
  FROM predictions GROUP BY 1, 2),
totals AS (SELECT procedure_code, sum(p) AS all_p, sum(n) AS all_n FROM steps GROUP BY 1),
pairs AS (
  SELECT procedure_code, sum(p * (below + n / 2)) AS won
  FROM (SELECT *, coalesce(sum(n) OVER (PARTITION BY procedure_code ORDER BY s
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM steps) GROUP BY 1),
points AS (
  SELECT procedure_code, p, s, sum(p) OVER w / (sum(p) OVER w + sum(n) OVER w) AS prec
  FROM steps WINDOW w AS (PARTITION BY procedure_code ORDER BY s DESC)),
curve AS (
  SELECT procedure_code, sum(p * (prec + coalesce(prev, prec)) / 2) AS area
  FROM (SELECT *, lag(prec) OVER (PARTITION BY procedure_code ORDER BY s DESC) AS prev FROM points) GROUP BY 1)
SELECT procedure_code, CASE WHEN all_p * all_n > 0 THEN {r('won / nullif(all_p * all_n, 0)', 6)} END AS auc_roc,
  CASE WHEN all_p > 0 THEN {r('area / nullif(all_p, 0)', 6)} END AS auc_pr
FROM totals JOIN pairs USING (procedure_code) JOIN curve USING (procedure_code)""")
ORACLES["multiclass_metrics"] = on(PREDICTIONS + "," + weighted_metrics(), "SELECT " + ", ".join(
    f'{r(m, 4)} AS {m}' for m in ("f1", '"precision"', "recall", "accuracy")) + " FROM metrics")
ORACLES["split_accuracy"] = on(PREDICTIONS, f"""
SELECT split, count(*) AS n, {r('avg((label = prediction)::int)', 4)} AS accuracy FROM predictions GROUP BY split""")
_test_rows = "SELECT count(*) AS n_rows, 0::bigint AS {column} FROM predictions WHERE split = 'test'"
ORACLES["model_roundtrip"] = on(PREDICTIONS, _test_rows.format(column="different"))
ORACLES["tree_shap_additivity"] = on(CLAIMS, "SELECT count(*) AS n_rows, 0::bigint AS not_additive FROM claims")
ORACLES["explained_gbt_additivity"] = ORACLES["tree_shap_additivity"]
ORACLES["tree_walk"] = ("SELECT 80::bigint AS n_trees, 0::bigint AS not_reached, 0::bigint AS too_deep, "
                        "0::bigint AS wrong_rows")
ORACLES["dependence_rows"] = on(CLAIMS, "SELECT 10::bigint AS n_features, count(*) AS fewest, count(*) AS most FROM claims")
ORACLES["predict_as_expression"] = on(PREDICTIONS, """
SELECT count(*) AS n_rows, 0::bigint AS other_prediction, 0::bigint AS other_margin FROM predictions WHERE split = 'test'""")
ORACLES["lr_gradient"] = "SELECT unnest([" + ", ".join(f"'{f}'" for f in ["intercept", *FEATURES]) + "]) AS term, true AS is_zero"
ORACLES["unusable_rows"] = on(CLAIMS, 'SELECT count(*) AS "rows", 0::bigint AS skipped_rows FROM claims')
_weight = {f: (i + 1) / 100 for i, f in enumerate(FEATURES)}
ORACLES["linear_shap"] = on(INDEX_ROWS, """,
means AS (SELECT """ + ", ".join(f"avg({f}) AS m_{f}" for f in FEATURES) + """ FROM indexed)
SELECT claim_id, """ + ", ".join(
    f"{r(f'{w}::double * ({f} - m_{f})', 4)} AS shap_{f}" for f, w in _weight.items()) + """
FROM indexed, means""")
ORACLES["global_importance"] = on(INDEX_ROWS, " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {r(f'avg(abs({w}::double * ({f} - (SELECT avg({f}) FROM indexed))))', 6)} "
    "AS mean_abs_attr FROM indexed" for f, w in _weight.items()))

_columns = {
    "claim_id": "text", "patient_id": "text", "age": "number", "sex": "text", "bmi": "number", "children": "number",
    "smoker": "", "claim_amount": "number", "procedure_code": "text", "procedure_description": "text",
    "provider_id": "text", "days_since_last_claim": "number", "diagnosis_code": "text", "is_fraud": "",
    "kafka_ts": "", "kafka_offset": "number", "kafka_partition": "number", "submission_ts": "", "ingestion_ts": "",
    "region": "text",
}


def _profiled(column: str, kind: str) -> str:
    number = f"min({column})::double AS min_number, max({column})::double AS max_number"
    words = f"min({column}) AS min_text, max({column}) AS max_text"
    return f"""SELECT '{column}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {column} IS NULL) AS n_nulls,
  {number if kind == 'number' else 'NULL::double AS min_number, NULL::double AS max_number'},
  {words if kind == 'text' else 'NULL::varchar AS min_text, NULL::varchar AS max_text'} FROM claims"""


ORACLES["claims_profile"] = on(CLAIMS, " UNION ALL ".join(_profiled(c, k) for c, k in _columns.items()))
