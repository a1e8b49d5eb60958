"""Every registered query that has SQL, compared value by value on the smallest tables."""

import pytest

from catalog.check import compare, connect
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from tests.conftest import SF

# need a trained model; test_models covers them with a smaller one
MODEL_BASED = {
    "model_roundtrip", "tree_shap_additivity", "explained_gbt_additivity", "predict_as_expression", "lr_gradient",
    "out_of_fold_scores", "tree_walk", "dependence_rows",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - MODEL_BASED))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry_runs(spark):
    from __spark_entry__ import entry

    rows = entry(spark).collect()
    assert {r["region"] for r in rows} == {"northeast", "northwest", "southeast", "southwest", "unknown"}


@pytest.mark.parametrize("name", [
    "region_fraud_patterns", "claim_distribution_bmi_age", "suspicious_high_value_claims", "provider_anomaly_summary",
    "procedure_code_fraud_analysis", "fraud_rate_by_region", "top_suspicious_claims",
])
def test_reports_keep_their_order(spark, con, name):
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name]).fetchall()
    assert [tuple(r) for r in got.collect()] == want
