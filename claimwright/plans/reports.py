"""Fraud reports and dashboard panels over the feature table.

Each function takes the feature table and returns a DataFrame; nothing is executed before it is written or
shown. Reports with a limit sort by a unique last key, so ties at the amount cap do not make them vary."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from claimwright.functions.cleaning import share_pct
from claimwright.sources.tables import save_ordered_report, save_report

# Cut-offs and sizes of the reports.
SUSPICIOUS_AMOUNT, SUSPICIOUS_ROWS = 25000, 50
PROVIDER_MIN_CLAIMS, PROVIDER_ROWS = 3, 25
FLAGGED_SCORE, FLAGGED_ROWS = 4, 100
PANEL_AMOUNT, PANEL_ROWS = 20000, 20
PANEL_DAYS = 7


def _n() -> Column:
    return F.count("*")


def _fraud_n() -> Column:
    return F.sum(F.col("is_fraud").cast("int"))


def _fraud_pct() -> Column:
    return share_pct(_fraud_n(), _n())


def _avg(column: str, digits: int) -> Column:
    return F.round(F.avg(column), digits)


def _avg_where(condition: Column, column: str, digits: int) -> Column:
    return F.round(F.avg(F.when(condition, F.col(column))), digits)


# --- analytic reports -----------------------------------------------------------------------------------


def region_fraud_patterns(features: DataFrame) -> DataFrame:
    return features.groupBy("region").agg(
        _n().alias("total_claims"),
        _fraud_n().alias("fraud_claims"),
        _fraud_pct().alias("fraud_rate_pct"),
        _avg("claim_amount", 2).alias("avg_claim_amount"),
        F.round(F.max("claim_amount"), 2).alias("max_claim_amount"),
        _avg("anomaly_score_proxy", 3).alias("avg_risk_score"),
    ).orderBy(F.desc("fraud_rate_pct"), "region")


def top_risk_feature_comparison(features: DataFrame) -> DataFrame:
    fraud, normal = F.col("is_fraud"), ~F.col("is_fraud")
    columns = []
    for source, name, digits in (
        ("anomaly_score_proxy", "avg_risk_score", 3),
        ("charge_per_age", "avg_charge_per_age", 2),
        ("log_claim_amount", "avg_log_claim", 4),
    ):
        columns.append(_avg_where(fraud, source, digits).alias(f"{name}_fraud"))
        columns.append(_avg_where(normal, source, digits).alias(f"{name}_normal"))
    return features.agg(
        *columns,
        F.count_if(fraud & (F.col("smoker_obese_flag") == 1)).alias("fraud_smoker_obese"),
        F.count_if(fraud & (F.col("rapid_resubmission") == 1)).alias("fraud_rapid_resubmit"),
    )


def claim_distribution_bmi_age(features: DataFrame) -> DataFrame:
    return features.groupBy("bmi_category", "age_group").agg(
        _n().alias("claim_count"),
        _avg("claim_amount", 2).alias("avg_claim"),
        F.round(F.min("claim_amount"), 2).alias("min_claim"),
        F.round(F.max("claim_amount"), 2).alias("max_claim"),
        _fraud_n().alias("fraud_count"),
        _fraud_pct().alias("fraud_pct"),
    ).orderBy(F.desc("avg_claim"), "bmi_category", "age_group")


def suspicious_high_value_claims(features: DataFrame) -> DataFrame:
    flagged = (
        (F.col("rapid_resubmission") == 1)
        | (F.col("young_high_procedure_flag") == 1)
        | (F.col("provider_high_volume_flag") == 1)
    )
    return features.filter((F.col("claim_amount") > SUSPICIOUS_AMOUNT) & flagged).select(
        "claim_id", "patient_id", "age",
        F.round("bmi", 1).alias("bmi"),
        F.round("claim_amount", 2).alias("claim_amount"),
        "procedure_code", "provider_id", "region", "days_since_last_claim",
        F.round("anomaly_score_proxy", 2).alias("risk_score"),
        "is_fraud",
    ).orderBy(F.desc("claim_amount"), "claim_id").limit(SUSPICIOUS_ROWS)


def provider_anomaly_summary(features: DataFrame) -> DataFrame:
    return features.groupBy("provider_id").agg(
        _n().alias("total_claims"),
        _fraud_n().alias("confirmed_fraud"),
        _fraud_pct().alias("fraud_rate_pct"),
        _avg("claim_amount", 2).alias("avg_claim"),
        F.round(F.max("claim_amount"), 2).alias("max_claim"),
        _avg("anomaly_score_proxy", 3).alias("avg_risk_score"),
        F.sum("rapid_resubmission").alias("rapid_resubmission_count"),
    ).filter(F.col("total_claims") > PROVIDER_MIN_CLAIMS).orderBy(
        F.desc("confirmed_fraud"), F.desc("avg_risk_score"), "provider_id"
    ).limit(PROVIDER_ROWS)


def explainability_flagged_claims(features: DataFrame) -> DataFrame:
    return features.filter(F.col("anomaly_score_proxy") >= FLAGGED_SCORE).select(
        "claim_id", "age", "bmi_category", "age_group", "procedure_risk", "region",
        F.round("claim_amount", 2).alias("claim_amount"),
        F.round("anomaly_score_proxy", 2).alias("risk_score"),
        "smoker_obese_flag", "rapid_resubmission", "young_high_procedure_flag",
        "provider_high_volume_flag", "claim_above_region_p95", "is_fraud",
    ).orderBy(F.desc("risk_score"), F.desc("claim_amount"), "claim_id").limit(FLAGGED_ROWS)


def procedure_code_fraud_analysis(features: DataFrame) -> DataFrame:
    return features.groupBy("procedure_code", "procedure_description", "procedure_risk").agg(
        _n().alias("total_claims"),
        _fraud_n().alias("fraud_claims"),
        _fraud_pct().alias("fraud_rate_pct"),
        _avg("claim_amount", 2).alias("avg_claim_amount"),
    ).orderBy(F.desc("fraud_rate_pct"), "procedure_code", "procedure_description")


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    f.__name__: f
    for f in (
        region_fraud_patterns,
        top_risk_feature_comparison,
        claim_distribution_bmi_age,
        suspicious_high_value_claims,
        provider_anomaly_summary,
        explainability_flagged_claims,
        procedure_code_fraud_analysis,
    )
}


#: Reports whose key is free text: as many rows as the data has texts.
UNBOUNDED = {"procedure_code_fraud_analysis"}


class ReportError(RuntimeError):
    """Some reports failed; `failures` maps their names to the errors, the others are written."""

    def __init__(self, failures: dict[str, Exception]):
        super().__init__("; ".join(f"{name}: {exc}" for name, exc in failures.items()))
        self.failures = failures


def run_reports(features: DataFrame, path: str,
                reports: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """Write every report as CSV below `path` and return `(report, row_count)` of the written files.

    Each report runs once. One that fails does not stop the others, but the failure is raised at the end."""
    counts, failures = [], {}
    for name, report in (reports or REPORTS).items():
        try:
            save = save_ordered_report if name in UNBOUNDED else save_report
            written = save(report(features), f"{path}/{name}")
            counts.append(written.agg(F.lit(name).alias("report"), _n().alias("row_count")))
        except Exception as exc:  # reported below
            failures[name] = exc
    if failures:
        raise ReportError(failures)
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total


# --- dashboard panels -----------------------------------------------------------------------------------


def total_claims(features: DataFrame) -> DataFrame:
    return features.agg(_n().alias("total_claims"))


def overall_fraud_rate(features: DataFrame) -> DataFrame:
    return features.agg(share_pct(F.count_if("is_fraud"), _n()).alias("fraud_rate"))


def latest_metric(metrics: DataFrame, name: str = "auc_roc", model: str = "gbt") -> DataFrame:
    """Newest value of one metric of one model, the higher one if a run has two; a plain aggregation, no sort."""
    return metrics.filter((F.col("metric_name") == name) & (F.col("model") == model)).agg(
        F.max(F.struct("run_ts", "metric_value"))["metric_value"].alias("metric_value")
    )


def avg_fraud_claim(features: DataFrame) -> DataFrame:
    return features.filter(F.col("is_fraud")).agg(_avg("claim_amount", 2).alias("avg_fraud_claim"))


def fraud_rate_by_region(features: DataFrame) -> DataFrame:
    return features.groupBy("region").agg(
        share_pct(F.count_if("is_fraud"), _n()).alias("fraud_rate_pct")
    ).orderBy(F.desc("fraud_rate_pct"), "region")


def top_suspicious_claims(features: DataFrame) -> DataFrame:
    return features.filter(F.col("claim_amount") > PANEL_AMOUNT).select(
        "claim_id", "age", "region", "procedure_code",
        F.round("claim_amount", 2).alias("claim_amount"),
        F.round("anomaly_score_proxy", 1).alias("risk_score"),
        "is_fraud",
    ).orderBy(F.desc("claim_amount"), "claim_id").limit(PANEL_ROWS)


def claims_over_time(claims: DataFrame, as_of: datetime | None = None, days: int = PANEL_DAYS,
                     ts: str = "ingestion_ts") -> DataFrame:
    """Normal and fraud claims per hour over the last days before `as_of` (now, if not given)."""
    end = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    recent = claims.filter(F.col(ts).cast("timestamp") > end - F.make_dt_interval(F.lit(days)))
    return recent.groupBy(F.date_trunc("hour", F.col(ts).cast("timestamp")).alias("time")).agg(
        F.count_if(~F.col("is_fraud")).alias("normal_claims"),
        F.count_if("is_fraud").alias("fraud_claims"),
    ).orderBy("time")


# Colour bands of the panels; a band starts at its bound.
PANEL_BANDS = {
    "total_claims": [(None, "green"), (40000, "yellow"), (80000, "red")],
    "fraud_rate": [(None, "green"), (6, "orange"), (12, "red")],
    "auc_roc": [(None, "green"), (0.88, "yellow"), (0.92, "green")],
    "avg_fraud_claim": [(None, "green"), (5000, "orange"), (15000, "red")],
    "risk_score": [(None, "green"), (3, "yellow"), (5, "red")],
}


def band(value: Column, panel: str) -> Column:
    """Colour of a panel's value."""
    steps = PANEL_BANDS[panel]
    colour = F.lit(steps[0][1])
    for bound, name in steps[1:]:
        colour = F.when(value >= bound, name).otherwise(colour)
    return colour


def threshold_status(features: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """Value and colour of the single-value panels: one scan of the feature table, and the newest AUC if the
    metrics table is given."""
    values = {
        "total_claims": _n().cast("double"),
        "fraud_rate": share_pct(F.count_if("is_fraud"), _n()),
        "avg_fraud_claim": _avg_where(F.col("is_fraud"), "claim_amount", 2),
        "risk_score": _avg("anomaly_score_proxy", 1),
    }
    status = _banded(features.agg(*[v.alias(k) for k, v in values.items()]))
    if metrics is not None:
        status = status.unionByName(_banded(latest_metric(metrics).withColumnRenamed("metric_value", "auc_roc")))
    return status


def _banded(row: DataFrame) -> DataFrame:
    """One row of panel values as `(panel, value, band)` rows."""
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("panel"), F.col(k).alias("value"), band(F.col(k), k).alias("band"))
        for k in row.columns
    ])).alias("s")).select("s.*")


# --- retraining report ----------------------------------------------------------------------------------

# Lines of the report; {model.metric} is replaced by its latest value or N/A.
REPORT_LINES = [
    ("header", "Automated Retraining Report"),
    ("header", "Run timestamp : {run_ts} UTC"),
    ("header", "Run ID        : {run_id}"),
    ("header", "Input files   : {input_files}"),
    ("gbt", "GBT Classifier Results"),
    ("gbt", "  AUC-ROC    : {gbt.auc_roc}"),
    ("gbt", "  AUC-PR     : {gbt.auc_pr}"),
    ("gbt", "  F1 Score   : {gbt.f1}"),
    ("gbt", "  Precision  : {gbt.precision}"),
    ("gbt", "  Recall     : {gbt.recall}"),
    ("gbt", "  Accuracy   : {gbt.accuracy}"),
    ("logistic_regression", "Logistic Regression Baseline"),
    ("logistic_regression", "  AUC-ROC    : {logistic_regression.auc_roc}"),
    ("logistic_regression", "  F1 Score   : {logistic_regression.f1}"),
    ("status", "Status: Retraining completed successfully."),
]


def retraining_report(metrics: DataFrame, *, run_id: str, run_ts: datetime,
                      input_files: int | None = None) -> DataFrame:
    """Report as `(section, line_no, text)` rows with the newest value of each metric, `N/A` where none is.

    `metrics` is reduced to one row of named values by a conditional aggregation; no join, no driver loop over
    data."""
    facts = {"run_ts": run_ts.isoformat(), "run_id": run_id,
             "input_files": "N/A" if input_files is None else str(input_files)}
    latest, lines = {}, []
    for number, (section, template) in enumerate(REPORT_LINES, start=1):
        head, name, tail = _placeholder(template)
        if name is None:
            text = F.lit(head)
        elif name in facts:
            text = F.lit(head + facts[name] + tail)
        else:
            model, metric = name.split(".")
            alias = f"{model}__{metric}"
            mine = (F.col("model") == model) & (F.col("metric_name") == metric)
            latest[alias] = F.max_by(
                F.when(mine, F.col("metric_value")), F.when(mine, F.col("run_ts"))
            ).alias(alias)
            text = F.concat(F.lit(head), F.coalesce(F.col(alias).cast("string"), F.lit("N/A")), F.lit(tail))
        lines.append(F.struct(F.lit(section).alias("section"), F.lit(number).alias("line_no"), text.alias("text")))
    row = metrics.agg(*latest.values())
    return row.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def _placeholder(template: str) -> tuple[str, str | None, str]:
    found = re.search(r"\{([^}]+)\}", template)
    if not found:
        return template, None, ""
    return template[: found.start()], found.group(1), template[found.end():]
