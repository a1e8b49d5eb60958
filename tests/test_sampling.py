"""Splits, samples and oversampling."""

import pytest
from pyspark.sql import functions as F

from claimwright.operators import sampling
from claimwright.operators.evaluation import with_label


def ids(df):
    return sorted(r["claim_id"] for r in df.select("claim_id").collect())


@pytest.fixture
def labelled(make_claims):
    return with_label(make_claims(*[{"claim_id": f"C{i}", "is_fraud": i % 10 == 0} for i in range(200)]))


def test_hash_split_ignores_partitioning(labelled):
    first = sampling.hash_split(labelled.repartition(3)).filter("split = 'train'")
    second = sampling.hash_split(labelled.repartition(7, "age")).filter("split = 'train'")
    assert ids(first) == ids(second) and 130 < first.count() < 185


def test_stratified_split_is_exact(labelled):
    counts = {(r["label"], r["split"]): r["count"]
              for r in sampling.stratified_split(labelled).groupBy("label", "split").count().collect()}
    assert counts == {(0, "train"): 144, (0, "test"): 36, (1, "train"): 16, (1, "test"): 4}


def test_balanced_sample(labelled):
    sample = sampling.balanced_sample(labelled, per_class=15)
    assert sample.groupBy("is_fraud").count().orderBy("is_fraud").collect() == [(False, 15), (True, 15)]
    assert ids(sample) == ids(sampling.balanced_sample(labelled.repartition(5), per_class=15))
    assert sampling.balanced_sample(labelled, per_class=1000).count() == 200


def test_ratio_is_capped_and_guarded(labelled):
    assert sampling.class_ratio(labelled) == 5.0
    assert sampling.class_ratio(labelled, max_ratio=20.0) == 9.0
    assert sampling.class_ratio(labelled.filter("label = 0")) is None


def test_every_label_is_a_stratum(labelled):
    odd = labelled.withColumn("label", F.when(F.col("age") > 0, F.when(
        F.substring("claim_id", -1, 1) == "3", 7).when(F.substring("claim_id", -1, 1) != "4", F.col("label"))))
    counts = {(r["label"], r["split"]): r["count"]
              for r in sampling.stratified_split(odd).groupBy("label", "split").count().collect()}
    assert counts[(7, "train")] == 16 and counts[(None, "train")] == 16 and counts[(0, "train")] == 112


def test_first_by_hash(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("claim_id"))
    few = sampling.first_by_hash(rows, 20)
    assert ids(few) == ids(rows.orderBy(F.md5("claim_id")).limit(20))
    assert sampling.first_by_hash(rows, 6000).count() == 5000


def test_poisson_ignores_partitioning(labelled):
    assert ids(sampling.oversample_poisson(labelled)) == ids(sampling.oversample_poisson(labelled.repartition(7)))


def test_replicated(labelled):
    more = sampling.oversample_replicated(labelled)
    assert more.count() == 180 + 20 * 5 and more.columns == labelled.columns
    assert more.filter("label = 1").distinct().count() == 20


def test_poisson(labelled):
    more = sampling.oversample_poisson(labelled)
    assert more.filter("label = 0").count() == 180
    assert 60 < more.filter("label = 1").count() < 140


@pytest.mark.parametrize("method", [sampling.oversample_poisson, sampling.oversample_replicated])
def test_without_fraud_nothing_changes(labelled, method):
    normal = labelled.filter("label = 0")
    assert ids(method(normal)) == ids(normal)


def test_rows_without_class_vanish(make_claims):
    claims = make_claims({"claim_id": "a", "is_fraud": None}, {"claim_id": "b"}, {"claim_id": "c", "is_fraud": True})
    assert ids(sampling.oversample_replicated(claims)) == ["b", "c"]


def test_bernoulli(spark):
    rows = spark.range(4000)
    part = sampling.bernoulli_sample(rows, 0.25, key="id")
    assert 800 < part.count() < 1200 and sampling.bernoulli_sample(rows, 1.0).count() == 4000
    again = sampling.bernoulli_sample(rows.repartition(7), 0.25, key="id")
    assert {r.id for r in part.collect()} == {r.id for r in again.collect()}


def test_a_draw_is_hashed_once(labelled):
    plan = sampling.oversample_poisson(labelled)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
