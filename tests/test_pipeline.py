"""Sinks, gates, reports, the retraining run, and the plans of the main queries."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from catalog import inputs
from claimwright.operators.dedup import dedup_claims
from claimwright.operators.joins import with_provider_stats, with_region_stats
from claimwright.operators.messages import decode_messages
from claimwright.operators.profile import profile
from claimwright.operators.stats import provider_stats, region_stats
from claimwright.operators.validation import normalise, validate
from claimwright.plans import benchmarks, reports, workflow
from claimwright.session import BYTES_PER_PARTITION, DEFAULTS, build_session, shared_dir, size_shuffles, sized_shuffles
from claimwright.sources import external, tables
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_session_keeps_a_running_one(spark):
    assert build_session(conf={"spark.sql.session.timeZone": "UTC"}) is not None
    assert DEFAULTS["spark.sql.session.timeZone"] == "UTC"
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_shuffles_are_sized_upwards(spark):
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    try:
        assert size_shuffles(spark, 10) == int(before) and spark.conf.get(setting) == before
        assert size_shuffles(spark, 100 * BYTES_PER_PARTITION + 1) == 101 and spark.conf.get(setting) == "101"
    finally:
        spark.conf.set(setting, before)


def test_input_gate(spark, tmp_path):
    with pytest.raises(tables.NoInputError):
        tables.require_input(spark, str(tmp_path / "missing"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(tables.NoInputError):
        tables.require_input(spark, str(tmp_path / "empty"))
    path = str(tmp_path / "data")
    spark.range(10).repartition(3).write.parquet(path)
    assert tables.require_input(spark, path) == 3
    row = tables.input_summary(spark, path).first()
    assert row["data_files"] == 3 and row["total_bytes"] > 0


def test_save_table_serves_table_and_path(spark, features, tmp_path):
    path = str(tmp_path / "features")
    few = features.limit(50)
    for _ in range(2):  # overwrites
        saved = tables.save_table(few, "sink_check.claim_features", path)
    assert saved.count() == spark.read.parquet(path).count() == 50
    assert saved.columns == features.columns
    managed = tables.save_table(few, "sink_check.managed")
    assert managed.count() == 50


def test_reports_by_sql_on_the_saved_table(spark, features, tmp_path):
    """What a user types against the catalog gives what the report functions give."""
    tables.save_table(features, "report_check.claim_features")
    metrics = str(tmp_path / "metrics")
    inputs.metric_history(spark, SF).write.parquet(metrics)
    tables.create_dashboard_views(spark, "report_check", "report_check.claim_features", metrics)
    by_sql = spark.sql("""
        SELECT region, count(*) AS total_claims, count_if(is_fraud) AS fraud_claims,
               round(avg(claim_amount), 2) AS avg_claim_amount
        FROM report_check.claim_features_view GROUP BY region ORDER BY region""")
    report = reports.region_fraud_patterns(features).select(by_sql.columns).orderBy("region")
    assert by_sql.collect() == report.collect()
    hours = spark.sql("""
        SELECT date_trunc('hour', ingestion_ts) AS time, count(*) FILTER (WHERE NOT is_fraud) AS normal_claims,
               count(*) FILTER (WHERE is_fraud) AS fraud_claims
        FROM report_check.claim_features_view WHERE ingestion_ts > timestamp '2024-01-02' - INTERVAL 7 DAYS
        GROUP BY 1 ORDER BY 1""")
    assert hours.collect() == reports.claims_over_time(features, datetime(2024, 1, 2)).collect()
    newest = spark.sql("""
        SELECT metric_value FROM report_check.model_metrics_view WHERE metric_name = 'accuracy'
          AND model = 'gbt'
        ORDER BY run_ts DESC LIMIT 1""")
    assert newest.collect() == reports.latest_metric(inputs.metric_history(spark, SF), "accuracy").collect()


def test_a_failing_report_is_raised_after_the_others(features, tmp_path):
    def broken(df):
        return df.select("no_such_column")

    with pytest.raises(reports.ReportError) as caught:
        reports.run_reports(features, str(tmp_path), {"broken": broken, "total_claims": reports.total_claims})
    assert set(caught.value.failures) == {"broken"}
    assert list((tmp_path / "total_claims").glob("part-*.csv"))


def test_report_is_one_file_with_header(features, tmp_path):
    written = tables.save_report(reports.claim_distribution_bmi_age(features), str(tmp_path / "r"))
    files = list((tmp_path / "r").glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text().startswith("bmi_category,age_group,claim_count")
    assert written.collect() == reports.claim_distribution_bmi_age(features).collect()


@pytest.mark.parametrize("value, panel, colour", [
    (39999.0, "total_claims", "green"), (40000.0, "total_claims", "yellow"), (80000.0, "total_claims", "red"),
    (5.99, "fraud_rate", "green"), (6.0, "fraud_rate", "orange"), (12.0, "fraud_rate", "red"),
    (0.87, "auc_roc", "green"), (0.88, "auc_roc", "yellow"), (0.92, "auc_roc", "green"),
    (15000.0, "avg_fraud_claim", "red"), (3.0, "risk_score", "yellow"), (5.0, "risk_score", "red"),
])
def test_bands(spark, value, panel, colour):
    assert spark.range(1).select(reports.band(F.lit(value), panel)).first()[0] == colour


def test_status_with_metrics(spark, features):
    rows = [("gbt", "auc_roc", 0.95, datetime(2024, 1, 1)), ("gbt", "auc_roc", 0.9, datetime(2024, 1, 8)),
            ("gbt", "f1", 0.1, datetime(2024, 2, 1))]
    metrics = spark.createDataFrame(rows, "model string, metric_name string, metric_value double, run_ts timestamp")
    status = {r["panel"]: (r["value"], r["band"]) for r in reports.threshold_status(features, metrics).collect()}
    assert status["auc_roc"] == (0.9, "yellow") and len(status) == 5


def test_panels_on_no_rows(features):
    none = features.limit(0)
    assert reports.overall_fraud_rate(none).first()[0] is None
    assert reports.top_risk_feature_comparison(none).first()["fraud_smoker_obese"] == 0
    assert workflow.dataset_summary(none).first().asDict() == {"total": 0, "fraud_count": 0, "fraud_pct": None}


def test_report_text_without_metrics(spark):
    none = spark.createDataFrame([], "model string, metric_name string, metric_value double, run_ts timestamp")
    lines = reports.retraining_report(none, run_id="r1", run_ts=datetime(2024, 1, 8), input_files=3)
    text = [r["text"] for r in lines.orderBy("line_no").collect()]
    assert text[0] == "Automated Retraining Report" and text[3] == "Input files   : 3"
    assert text[5] == "  AUC-ROC    : N/A" and len(text) == 15


def test_profile(spark):
    rows = spark.createDataFrame([(1, "b", None), (None, "a", True)], "n int, t string, f boolean")
    got = {r["column_name"]: tuple(r)[1:] for r in profile(rows).collect()}
    assert got == {"n": (2, 1, 1.0, 1.0, None, None), "t": (2, 0, None, None, "a", "b"),
                   "f": (2, 1, None, None, None, None)}


def test_external_sources(spark, tmp_path):
    path = tmp_path / "insurance.csv"
    path.write_text("age,sex,bmi,children,smoker,region,charges\n19,female,27.9,0, YES,southwest,16884.92\n"
                    "18,male,33.8,1,no,southeast,1725.55\n")
    rows = external.insurance_to_claims(external.read_insurance_csv(spark, str(path))).collect()
    assert [r["smoker"] for r in rows] == [True, False] and rows[0]["claim_amount"] == 16884.92
    path = tmp_path / "cms.csv"
    path.write_text("CLM_ID,DESYNPUF_ID,BENE_BIRTH_DT,BENE_SEX_IDENT_CD,CLM_PMT_AMT,CLM_FROM_DT,AT_PHYSN_NPI,HCPCS_CD,"
                    "ICD9_DGNS_CD_1\n1,A,19480229,1,10.5,20080228,7,27447,V1\n2,B,19500301,2,1,20080301,8,G0008,V2\n"
                    "3,C,bad,9,1,,8,99213,V3\n")
    rows = external.cms_to_claims(external.read_cms_csv(spark, str(path))).orderBy("claim_id").collect()
    assert [r["age"] for r in rows] == [59, 58, None]
    assert [r["sex"] for r in rows] == ["male", "female", None]
    assert [r["procedure_code"] for r in rows] == ["27447", None, "99213"]
    assert rows[0]["provider_id"] == "PRV7" and rows[0]["submission_timestamp"] == "2008-02-28T00:00:00"
    assert rows[0]["procedure_description"] == "knee_replacement" and rows[2]["submission_timestamp"] is None


def test_retraining_run(spark, tmp_path):
    cfg = workflow.RunConfig(
        raw_path=inputs.claims_path(spark, SF), output_path=str(tmp_path), run_id="test", run_ts=datetime(2024, 1, 8),
        feature_table="run_check.claim_features", search=False, gbt_params={"maxIter": 3, "maxDepth": 3},
    )
    lines = workflow.run_pipeline(spark, cfg)
    text = [r["text"] for r in lines.orderBy("line_no").collect()]
    assert text[5].startswith("  AUC-ROC    : 0.9") or text[5].startswith("  AUC-ROC    : 1.0")
    assert "N/A" not in "".join(text)
    assert spark.table("run_check.claim_features").count() == inputs.claims(spark, SF).count()
    for name in ("confusion_matrix", "predictions_sample", "global_importance", "attribution_sample", "dependence",
                 "attributions", "reports/region_fraud_patterns", "metrics", "models/gbt"):
        assert (tmp_path / name).is_dir(), name
    assert spark.table("run_check.model_metrics_view").count() == 13


def test_retraining_stops_without_input(spark, tmp_path):
    with pytest.raises(tables.NoInputError):
        workflow.run_pipeline(spark, workflow.RunConfig(str(tmp_path / "none"), str(tmp_path / "out"), "x"))
    assert not (tmp_path / "out").exists()


# --- plans ----------------------------------------------------------------------------------------------


def test_region_filter_prunes_folders(spark):
    text = plan(inputs.claims(spark, SF).filter("region = 'northeast' and claim_amount > 10"))
    assert "PartitionFilters: [isnotnull(region" in text and "GreaterThan(claim_amount,10.0)" in text


def test_messages_are_parsed_once(spark):
    messages = spark.read.parquet(inputs.captured_path(spark, SF))
    text = plan(normalise(validate(decode_messages(messages)), datetime(2024, 1, 1)))
    assert text.count("from_json(") == 1


def test_reports_read_their_columns_only(spark):
    stored = inputs.features(spark, SF)
    spark.catalog.clearCache()
    text = plan(benchmarks.filter_project(stored))
    assert "ReadSchema: struct<region:string,claim_id:string,claim_amount:double,is_fraud:boolean>" in text
    assert "PushedFilters: [IsNotNull(claim_amount), GreaterThan(claim_amount,10000.0)]" in text
    assert "TakeOrderedAndProject" in plan(reports.suspicious_high_value_claims(stored))
    for function in reports.REPORTS.values():
        assert "Python" not in plan(function(stored)) and "CartesianProduct" not in plan(function(stored))


def test_joins_move_claims_only_when_providers_are_many(spark, tmp_path):
    claims = inputs.claims(spark, SF)
    providers = tables.save_parquet(provider_stats(claims), str(tmp_path / "p"))
    regions = tables.save_parquet(region_stats(claims), str(tmp_path / "r"))
    text = plan(with_region_stats(with_provider_stats(claims, providers), regions))
    assert text.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = plan(with_provider_stats(claims, providers, broadcast_rows=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert many.count("BroadcastHashJoin") == 1  # the hot providers
    # and the claims are shuffled by the salted key, not by the provider
    assert many.count("hashpartitioning(_key#") == 1 and "hashpartitioning(provider_id" not in many


def test_a_hot_provider_is_spread(spark, make_claims, tmp_path):
    claims = make_claims(*[{"claim_id": f"h{i}", "provider_id": "PRV9999"} for i in range(900)],
                         *[{"claim_id": f"c{i}", "provider_id": f"PRV{i}"} for i in range(2000)])
    stats = tables.save_parquet(provider_stats(claims), str(tmp_path / "p"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = with_provider_stats(claims, stats, broadcast_rows=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 4 and max(sizes) < 1.2 * 2900 / 4


def test_dedup_limits_groups_before_the_shuffle(make_claims):
    text = plan(dedup_claims(make_claims({}, {})))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_long_report_is_written_in_order_by_many_tasks(spark, tmp_path):
    from claimwright.sources.tables import read_manifest, save_ordered_report
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"), (F.col("id") % 97).alias("n"))
        report = rows.orderBy(F.desc("n"), "k")
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" in plan and "SinglePartition" not in plan
        written = save_ordered_report(report, str(tmp_path / "report"))
        files = read_manifest(spark, str(tmp_path / "report")).orderBy("file").collect()
        assert len(files) == 4 and sum(f["n_rows"] for f in files) == 5000
        assert [f["first_row"] for f in files] == [1 + sum(g["n_rows"] for g in files[:k]) for k in range(4)]
        whole = [tuple(r) for r in report.collect()]
        for f in files:
            own = {tuple(r) for r in written.where(F.col("_metadata.file_name") == f["file"]).collect()}
            assert own == set(whole[f["first_row"] - 1:f["first_row"] - 1 + f["n_rows"]])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_claims_keep_their_place_with_many_providers(spark, make_claims):
    """Sixty thousand providers are still broadcast, whatever Spark takes their size to be."""
    providers = spark.range(60_000).select(
        F.concat(F.lit("PRV"), F.col("id")).alias("provider_id"), F.lit(1).cast("long").alias("provider_total_claims"),
        F.lit(1.0).alias("provider_avg_claim"), F.lit(1.0).alias("provider_max_claim"),
        F.lit(0.0).alias("provider_fraud_rate"))
    claims = make_claims({"claim_id": "a"}, {"claim_id": "b", "provider_id": "PRV70000"}, {"claim_id": "c", "provider_id": None})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = with_provider_stats(claims, providers)
        assert "SortMergeJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert {r["claim_id"]: r["provider_avg_claim"] for r in joined.collect()} == {"a": 1.0, "b": None, "c": None}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_shuffles_follow_the_input_for_a_while(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), sized_shuffles(spark, 101, 10):
        assert spark.range(9).groupBy("id").count()._jdf.queryExecution().executedPlan() and spark.conf.get(name) == "11"
        raise ValueError
    assert spark.conf.get(name) == before
    with sized_shuffles(spark, 1, 10):
        assert spark.conf.get(name) == before  # never lowered


def test_claims_are_sorted_in_as_many_parts_as_their_tables_need(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(inputs, "write_raw_claims", lambda claims, path: seen.append(
        spark.conf.get("spark.sql.shuffle.partitions")))
    monkeypatch.setattr(inputs, "order_bytes", lambda spark, sf_dir: 100 * 16 * 2**20)
    monkeypatch.setattr(inputs, "_stored", {})
    inputs.claims_path(spark, "/root/testdata/sf0.001")
    assert seen == ["100"]


def test_registered_retraining_searches_the_whole_grid(spark, monkeypatch):
    from catalog.queries import QUERIES

    found = []
    monkeypatch.setattr(workflow, "run_pipeline", lambda spark, cfg: found.append(cfg))
    QUERIES["retrain_workflow"](spark, SF)
    assert found[0].grid is None and found[0].search and found[0].gbt_params == {}
