"""The streaming job against the batch job, over several files, with repetitions and a restart."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from claimwright.operators.dedup import dedup_claims
from claimwright.operators.messages import decode_messages, encode_messages
from claimwright.operators.validation import normalise, validate
from claimwright.plans.reports import claims_over_time
from claimwright.schema import CLAIM_SCHEMA, MESSAGE_SCHEMA
from claimwright.session import DEFAULTS
from claimwright.sources.streams import captured_messages, kafka_messages, kafka_options
from claimwright.sources.tables import read_raw_claims
from claimwright.streaming.hourly import hourly_counts
from claimwright.streaming.ingest import clean_stream, dedup_stream_within, land_stream
from tests.conftest import AS_OF

START = datetime(2023, 12, 1)


def write_messages(claims, path, offset):
    encode_messages(
        claims, topic=F.lit("t"), partition=F.lit(0), offset=F.lit(offset).cast("long"), timestamp=F.lit(AS_OF)
    ).select([f.name for f in MESSAGE_SCHEMA]).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def three_files(make_claims, tmp_path):
    """30 claims per file; each file repeats ten of the one before; some rows are invalid."""
    path = str(tmp_path / "messages")
    for part in range(3):
        rows = [{"claim_id": f"C{i}", "age": 0 if i % 11 == 0 else 40, "region": ["northeast", "mars"][i % 2]}
                for i in range(part * 20, part * 20 + 30)]
        write_messages(make_claims(*rows), path, part)
    return path


def run(stream, tmp_path, **options):
    query = land_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), trigger=None, **options)
    query.awaitTermination()
    return query


def ids(df):
    return sorted(r["claim_id"] for r in df.select("claim_id").collect())


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def state_on_disk(spark):
    spark.conf.set(STATE_STORE, DEFAULTS[STATE_STORE])
    yield
    spark.conf.unset(STATE_STORE)


@pytest.mark.parametrize("horizon", [None, "30 days"])
def test_stream_equals_batch(spark, three_files, tmp_path, state_on_disk, horizon):
    source = captured_messages(spark, three_files, files_per_trigger=1)
    query = run(clean_stream(source, horizon=horizon, as_of=AS_OF), tmp_path)
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 3
    landed = read_raw_claims(spark, str(tmp_path / "out"))
    batch = dedup_claims(normalise(validate(decode_messages(spark.read.parquet(three_files))), AS_OF))
    columns = [c for c in landed.columns if not c.startswith("kafka")]
    assert sorted(map(repr, landed.select(columns).collect())) == sorted(map(repr, batch.select(columns).collect()))
    assert {p.name for p in (tmp_path / "out").glob("region=*")} == {"region=northeast", "region=unknown"}


def test_restart_takes_only_what_is_new(spark, make_claims, three_files, tmp_path):
    def once():
        run(clean_stream(captured_messages(spark, three_files), as_of=AS_OF), tmp_path)
        return ids(read_raw_claims(spark, str(tmp_path / "out")))

    first = once()
    assert once() == first
    write_messages(make_claims({"claim_id": "C1"}, {"claim_id": "new"}), three_files, 9)
    assert once() == sorted([*first, "new"])


def test_bounded_state_policy(spark, make_claims, tmp_path):
    """A repetition within the horizon is dropped; a claim later than the horizon is not taken."""
    path = str(tmp_path / "messages")
    steps = [
        [("a", 0)],
        [("a", 1), ("b", 1)],
        [("c", 72)],
        [("late", 1), ("b", 71), ("d", 73)],
    ]
    for part, rows in enumerate(steps):
        write_messages(make_claims(*[
            {"claim_id": i, "submission_timestamp": (START + timedelta(hours=h)).isoformat()} for i, h in rows
        ]), path, part)
        source = normalise(validate(decode_messages(captured_messages(spark, path))), AS_OF)
        run(dedup_stream_within(source, "24 hours").select("claim_id"), tmp_path, partition_by=None)
    # b came again 70 hours later, when its state was gone
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == ["a", "b", "b", "c", "d"]


def test_missing_submission_time_follows_arrival(spark, make_claims, tmp_path):
    path = str(tmp_path / "messages")
    write_messages(make_claims({"submission_timestamp": "bad"}, {"submission_timestamp": None}), path, 0)
    source = normalise(validate(decode_messages(captured_messages(spark, path))), AS_OF)
    run(dedup_stream_within(source, "1 hour").select("claim_id"), tmp_path, partition_by=None)
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == ["C1"]


def test_hourly_counts_equal_the_panel(spark, tmp_path):
    rows = [(START + timedelta(minutes=7 * i), i % 3 == 0) for i in range(200)]
    events = spark.createDataFrame(rows, "ingestion_ts timestamp, is_fraud boolean")
    path = str(tmp_path / "events")
    events.filter("minute(ingestion_ts) < 30").coalesce(1).write.parquet(path)
    events.filter("minute(ingestion_ts) >= 30").coalesce(1).write.mode("append").parquet(path)
    stream = hourly_counts(spark.readStream.schema(events.schema).parquet(path))
    run(stream, tmp_path, partition_by=None)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    newest = rows[-1][0]
    panel = claims_over_time(events, newest, days=30)
    closed = [tuple(r) for r in panel.collect() if r["time"] + timedelta(hours=2) <= newest]
    assert got == closed


def test_message_schema_and_kafka_options(spark):
    assert kafka_options("broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "health_insurance_claims", "startingOffsets": "latest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "5000"}
    tuned = kafka_options("b", "t", starting="earliest", offsets_per_trigger=None, min_partitions=4, fail_on_data_loss=False)
    assert tuned == {"kafka.bootstrap.servers": "b", "subscribe": "t", "startingOffsets": "earliest",
                     "failOnDataLoss": "false", "minPartitions": "4"}
    with pytest.raises(Exception, match="(?i)kafka"):  # the connector is not installed with the tests
        kafka_messages(spark, "broker:9092", offsets_per_trigger=10, min_partitions=4)
    assert [f.name for f in MESSAGE_SCHEMA] == ["key", "value", "topic", "partition", "offset", "timestamp"]
    assert len(CLAIM_SCHEMA) == 16
