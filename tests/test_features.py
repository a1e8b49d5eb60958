"""Feature expressions, statistics, joins, indices and rules on hand-made rows."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from claimwright.functions.features import ENGINEERED
from claimwright.functions.rules import any_rule, expected_charge, fraud_rules, fraud_signatures
from claimwright.operators.indexing import category_index, fit_category_index
from claimwright.operators.joins import with_provider_stats, with_region_stats
from claimwright.operators.quantiles import exact_quantile
from claimwright.operators.stats import provider_stats, region_stats
from claimwright.plans.features import build_features, engineer
from claimwright.schema import CATEGORY_INDEX, FEATURES


def engineered(claims):
    return engineer(claims, provider_stats(claims), region_stats(claims))


def one(claims):
    return engineered(claims).first()


@pytest.mark.parametrize("bmi, name", [
    (18.49, "underweight"), (18.5, "normal"), (24.99, "normal"), (25.0, "overweight"), (29.99, "overweight"),
    (30.0, "obese"), (None, "obese"),
])
def test_bmi_category(make_claims, bmi, name):
    assert one(make_claims({"bmi": bmi}))["bmi_category"] == name


@pytest.mark.parametrize("age, name", [
    (29, "young"), (30, "middle"), (49, "middle"), (50, "senior"), (64, "senior"), (65, "elderly"), (None, "elderly"),
])
def test_age_group(make_claims, age, name):
    assert one(make_claims({"age": age}))["age_group"] == name


@pytest.mark.parametrize("code, name", [
    ("27447", "high"), ("43239", "high"), ("70553", "high"), ("93000", "medium"), ("71046", "medium"),
    ("80053", "medium"), ("99213", "low"), (None, "low"),
])
def test_procedure_risk(make_claims, code, name):
    assert one(make_claims({"procedure_code": code}))["procedure_risk"] == name


@pytest.mark.parametrize("change, flag, value", [
    ({"smoker": True, "bmi": 30.0}, "smoker_obese_flag", 1),
    ({"smoker": True, "bmi": 29.9}, "smoker_obese_flag", 0),
    ({"smoker": None, "bmi": 40.0}, "smoker_obese_flag", 0),
    ({"claim_amount": 20000.0}, "high_value_claim", 0),
    ({"claim_amount": 20000.01}, "high_value_claim", 1),
    ({"days_since_last_claim": 7}, "rapid_resubmission", 1),
    ({"days_since_last_claim": 8}, "rapid_resubmission", 0),
    ({"days_since_last_claim": None}, "rapid_resubmission", 0),
    ({"age": 29, "procedure_code": "27447"}, "young_high_procedure_flag", 1),
    ({"age": 30, "procedure_code": "27447"}, "young_high_procedure_flag", 0),
    ({"age": 29, "procedure_code": "43239"}, "young_high_procedure_flag", 0),
    ({"provider_id": "PRV9999"}, "provider_high_volume_flag", 1),
    ({"provider_id": None}, "provider_high_volume_flag", 0),
])
def test_flags(make_claims, change, flag, value):
    assert one(make_claims(change))[flag] == value


def test_edge_values(make_claims):
    row = one(make_claims({"age": -1}))
    assert row["charge_per_age"] is None  # no division by zero, in ANSI mode either
    row = one(make_claims({}))
    assert row["region_stddev_claim"] is None and row["claim_zscore_region"] == 0.0
    assert row["claim_above_region_p95"] == 0
    claims = make_claims({}, {"claim_id": "C2", "provider_id": None})
    missing = engineered(claims).filter("claim_id = 'C2'").first()
    assert missing["provider_avg_claim"] is None and missing["provider_claim_deviation"] == 1.0


def test_rounding_is_half_up_on_decimals(make_claims):
    assert one(make_claims({"age": 0, "claim_amount": 1.00005}))["charge_per_age"] == 1.0001


def test_score_reaches_its_ends(make_claims):
    top = {"claim_amount": 400000.0, "smoker": True, "bmi": 31.0, "days_since_last_claim": 1, "age": 25,
           "procedure_code": "27447", "provider_id": "PRV9999", "claim_id": "top"}
    claims = make_claims(top, *[{"claim_id": f"c{i}"} for i in range(40)])
    scores = {r["claim_id"]: r["anomaly_score_proxy"] for r in engineered(claims).collect()}
    assert scores["top"] == 11.0 and scores["c0"] == 0.0


def test_feature_table_has_46_columns(make_claims, tmp_path):
    claims = make_claims({}, {"claim_id": "C2", "sex": None}).withColumns({
        "kafka_ts": F.current_timestamp(), "kafka_offset": F.lit(1), "kafka_partition": F.lit(1),
        "submission_ts": F.current_timestamp(), "ingestion_ts": F.current_timestamp(),
    }).drop("submission_timestamp")
    table = build_features(claims, str(tmp_path))
    assert len(table.columns) == 46
    assert set(ENGINEERED) | set(FEATURES) <= set(table.columns)
    assert table.filter("claim_id = 'C2'").first()["sex_idx"] == 1.0  # null is indexed after the labels


def test_provider_join_agrees_on_every_path(spark, make_claims):
    hot = [{"claim_id": f"h{i}", "provider_id": "PRV9999", "claim_amount": 10.0 + i} for i in range(300)]
    cold = [{"claim_id": f"c{i}", "provider_id": f"PRV{i % 37}", "claim_amount": 1.0 + i} for i in range(120)]
    none = [{"claim_id": f"n{i}", "provider_id": None} for i in range(10)]
    claims = make_claims(*hot, *cold, *none)
    stats = provider_stats(claims).filter("provider_id is not null and provider_id <> 'PRV5'").cache()
    plain = claims.join(stats, "provider_id", "left")
    wanted = sorted(map(repr, plain.collect()))
    for rows in (50_000, 0):
        joined = with_provider_stats(claims, stats, broadcast_rows=rows)
        assert joined.columns == plain.columns
        assert sorted(map(repr, joined.collect())) == wanted


def test_region_join_outside_the_domain(make_claims):
    claims = make_claims({}, {"claim_id": "C2", "region": "mars"})
    stats = region_stats(claims)
    for rows in (0, 50_000):
        by_id = {r["claim_id"]: r for r in with_region_stats(claims, stats, broadcast_rows=rows).collect()}
        assert by_id["C1"]["region_avg_claim"] == by_id["C2"]["region_avg_claim"] == 5000.0


def test_approximate_percentile_option(make_claims):
    claims = make_claims(*[{"claim_id": str(i), "claim_amount": float(i)} for i in range(1, 101)])
    assert region_stats(claims).first()["region_p95_claim"] == 95.0
    assert region_stats(claims, accuracy=10000).first()["region_p95_claim"] == 95.0


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from([0.5, 49.9, 50.0, 50.5, 120.0, 500000.0, 3.25])),
             min_size=1, max_size=60),
    st.sampled_from([0.05, 0.5, 0.95, 1.0]),
)
def test_exact_quantile_equals_sorting(spark, rows, q):
    from decimal import Decimal
    from math import ceil

    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["x"] for r in exact_quantile(df, "g", "v", q, F.floor(F.col("v") / 50), "x").collect()}
    for group in {g for g, _ in rows}:
        values = sorted(v for g, v in rows if g == group)
        assert got[group] == values[max(1, ceil(Decimal(str(q)) * len(values))) - 1]


def test_quantile_of_many_groups_and_of_none(spark):
    df = spark.range(1000).selectExpr("id % 100 as g", "cast(id as double) as v")
    got = {r["g"]: r["x"] for r in exact_quantile(df, "g", "v", 0.5, F.floor(F.col("v") / 50), "x").collect()}
    assert got == {g: float(g + 400) for g in range(100)}
    assert exact_quantile(df.limit(0), "g", "v", 0.5, F.floor(F.col("v") / 50), "x").collect() == []


def test_index_agrees_with_relation(features):
    claims = features.drop(*CATEGORY_INDEX.values())
    table = category_index(claims).collect()
    indexed = fit_category_index(claims).transform(claims)
    for column, name in CATEGORY_INDEX.items():
        pairs = {(r[column], r[name]) for r in indexed.select(column, name).distinct().collect()}
        assert pairs == {(r["category"], r["idx"]) for r in table if r["column_name"] == column}


def test_rules(make_claims):
    rows = {
        "inflated": {"claim_amount": 25000.0},
        "rapid": {"days_since_last_claim": 7, "claim_amount": 15000.01},
        "young": {"age": 29, "procedure_code": "43239"},
        "watched": {"provider_id": "PRV9999"},
        "plain": {},
        "nulls": {"days_since_last_claim": None, "age": None, "procedure_code": None, "provider_id": None},
    }
    claims = make_claims(*[{"claim_id": k, **v} for k, v in rows.items()]).withColumn(
        "provider_claim_deviation", F.lit(1.0))
    flagged = {r["claim_id"]: r for r in claims.withColumns(fraud_rules()).withColumn(
        "label", any_rule(fraud_rules())).collect()}
    assert flagged["inflated"]["rule_inflation"] and flagged["rapid"]["rule_rapid_high"]
    assert flagged["young"]["rule_implausible_procedure"] and flagged["watched"]["rule_provider"]
    assert [flagged[k]["label"] for k in rows] == [True, True, True, True, False, False]
    far = claims.withColumn("provider_claim_deviation", F.lit(4.51)).withColumns(fraud_rules())
    assert all(r["rule_provider"] for r in far.collect())  # the half of rule 4 the order tables never reach
    assert claims.filter("claim_id = 'plain'").select(expected_charge()).first()[0] == 1800 + 40 * 55 + 27 * 35 + 450


def test_signatures(make_claims):
    claims = make_claims(
        {"claim_id": "1", "bmi": 42.0, "diagnosis_code": "Z99.89"},
        {"claim_id": "2", "days_since_last_claim": 3, "claim_amount": 52000.0, "procedure_code": "70553"},
        {"claim_id": "3", "age": 24, "procedure_code": "27447", "claim_amount": 28000.0, "bmi": 27.0},
        {"claim_id": "4", "provider_id": "PRV9999", "smoker": True, "claim_amount": 22000.0, "days_since_last_claim": 5},
        {"claim_id": "5"},
    )
    got = {r["claim_id"]: r["s"] for r in claims.select("claim_id", fraud_signatures().alias("s")).collect()}
    assert got == {"1": ["inflated_obese"], "2": ["rapid_expensive"], "3": ["young_knee"],
                   "4": ["watched_provider"], "5": []}
