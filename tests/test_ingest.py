"""Decoding, validity, normalisation and deduplication on hand-made rows."""

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from claimwright.functions.cleaning import clamped
from claimwright.operators.dedup import dedup_claims
from claimwright.operators.messages import decode_messages, encode_messages
from claimwright.operators.validation import normalise, reject_counts, rejected, validate
from claimwright.plans.features import clean_batch
from claimwright.schema import CLAIM_SCHEMA, MESSAGE_SCHEMA, RAW_SCHEMA
from tests.conftest import AS_OF, BASE_CLAIM


def messages(spark, *values):
    rows = [(b"k", v if isinstance(v, bytes) else json.dumps(v).encode(), "t", 0, i, datetime(2024, 1, 1))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def test_malformed_json_gives_nulls_and_is_dropped(spark):
    decoded = decode_messages(messages(spark, b"{bad", BASE_CLAIM))
    assert [r["claim_id"] for r in decoded.orderBy("kafka_offset").collect()] == [None, "C1"]
    assert validate(decoded).count() == 1


@pytest.mark.parametrize("age", ["x", 30.5])
def test_wrong_typed_field_is_null_alone(spark, age):
    row = decode_messages(messages(spark, {**BASE_CLAIM, "age": age})).first()
    assert row["age"] is None and row["claim_amount"] == 5000.0


def test_missing_and_extra_fields(spark):
    row = decode_messages(messages(spark, {"claim_id": "C9", "other": 1})).first()
    assert row["claim_id"] == "C9" and row["patient_id"] is None


@pytest.mark.parametrize("change, valid", [
    ({}, True),
    ({"claim_id": None}, False), ({"patient_id": None}, False), ({"region": None}, False),
    ({"age": 0}, False), ({"age": 1}, True), ({"age": 115}, True), ({"age": 116}, False), ({"age": None}, False),
    ({"bmi": 9.9}, False), ({"bmi": 10.0}, True), ({"bmi": 70.0}, True), ({"bmi": 70.1}, False),
    ({"bmi": None}, False),
    ({"claim_amount": 0.0}, False), ({"claim_amount": 0.01}, True), ({"claim_amount": None}, False),
    ({"sex": None}, True), ({"region": "mars"}, True), ({"region": " "}, True), ({"is_fraud": None}, True),
])
def test_validity_bounds(make_claims, change, valid):
    claims = make_claims(change)
    assert validate(claims).count() == int(valid)
    assert rejected(claims).count() == int(not valid)


def test_every_failed_check_is_named(make_claims):
    claims = make_claims({"age": 0, "bmi": None}, {"age": 200}, {})
    assert {r["reason"]: r["rejected_rows"] for r in reject_counts(claims).collect()} == {"age": 2, "bmi": 1}


def test_normalisation(make_claims):
    claims = make_claims(
        {"claim_id": "a", "sex": " Female ", "region": " SouthEast ", "claim_amount": 500000.01},
        {"claim_id": "b", "sex": None, "region": "", "claim_amount": 500000.0, "submission_timestamp": "bad-ts"},
        {"claim_id": "c", "sex": "x", "region": "overseas", "submission_timestamp": None},
    )
    rows = {r["claim_id"]: r for r in normalise(claims, AS_OF).collect()}
    assert (rows["a"]["sex"], rows["a"]["region"], rows["a"]["claim_amount"]) == ("female", "southeast", 500000.0)
    assert (rows["b"]["sex"], rows["b"]["region"], rows["b"]["claim_amount"]) == ("unknown", "unknown", 500000.0)
    assert (rows["c"]["sex"], rows["c"]["region"]) == ("unknown", "unknown")
    assert rows["a"]["submission_ts"] == datetime(2023, 12, 1, 10)
    assert rows["b"]["submission_ts"] is None and rows["c"]["submission_ts"] is None
    assert rows["a"]["ingestion_ts"] == AS_OF


def test_clamp(spark):
    rows = spark.createDataFrame([(5.0,), (10.0,), (70.5,), (None,)], "x double")
    assert [r[0] for r in rows.select(clamped(F.col("x"), 10.0, 70.0)).collect()] == [10.0, 10.0, 70.0, None]


def test_dedup_keeps_the_dearest_whatever_the_partitioning(make_claims):
    claims = make_claims(*[{"claim_amount": float(100 + i % 7), "bmi": 20.0 + i % 5, "provider_id": f"PRV{i}"}
                           for i in range(60)], {"claim_id": "other"})
    kept = {dedup_claims(claims.repartition(n)).filter("claim_id = 'C1'").first() for n in (1, 3, 8)}
    assert len(kept) == 1
    row = kept.pop()
    assert row["claim_amount"] == 106.0 and row["bmi"] == 20.0
    assert dedup_claims(claims).count() == 2


def test_raw_table_layout(make_claims):
    decoded = make_claims({}).withColumns({
        "kafka_ts": F.lit(AS_OF), "kafka_offset": F.lit(1).cast("long"), "kafka_partition": F.lit(0)})
    cleaned = clean_batch(decoded, AS_OF)
    assert cleaned.columns == [f.name for f in RAW_SCHEMA] and len(cleaned.columns) == 20
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in RAW_SCHEMA]


text = st.one_of(st.none(), st.text(alphabet="ab \"\\'{}é,:\n", max_size=6))
claim = st.fixed_dictionaries({
    "claim_id": text, "patient_id": text, "age": st.one_of(st.none(), st.integers(-5, 130)),
    "sex": text, "bmi": st.one_of(st.none(), st.floats(0, 90)), "region": text,
    "claim_amount": st.one_of(st.none(), st.floats(-10, 1e6)), "smoker": st.one_of(st.none(), st.booleans()),
})


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(claim, min_size=1, max_size=8))
def test_ingest_properties(make_claims, changes):
    claims = make_claims(*changes).cache()
    sent = encode_messages(claims, topic=F.lit("t"), partition=F.lit(0), offset=F.lit(0).cast("long"),
                           timestamp=F.lit(AS_OF))
    back = decode_messages(sent).select([f.name for f in CLAIM_SCHEMA])
    assert sorted(map(repr, back.collect())) == sorted(map(repr, claims.collect()))
    valid = validate(claims)
    assert sorted(map(repr, validate(valid).collect())) == sorted(map(repr, valid.collect()))
    assert valid.count() + rejected(claims).count() == len(changes)
    once = dedup_claims(valid)
    assert sorted(map(repr, dedup_claims(once).collect())) == sorted(map(repr, once.collect()))
    assert once.count() == valid.select("claim_id").distinct().count()
