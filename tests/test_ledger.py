"""Ingest with a ledger: forgetting, late claims, restarts in the middle of a batch, hot ids."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from catalog import inputs
from claimwright.operators.dedup import dedup_claims
from claimwright.operators.messages import decode_messages
from claimwright.operators.validation import normalise, validate
from claimwright.sources.streams import captured_messages
from claimwright.sources import tables
from claimwright.sources.tables import read_raw_claims
from claimwright.streaming import ledger
from tests.conftest import AS_OF, SF
from tests.test_streaming import START, ids, three_files, write_messages  # noqa: F401


def landing_in(tmp_path, **options):
    return ledger.Landing(str(tmp_path / "raw"), str(tmp_path / "state"), as_of=AS_OF, buckets=8, **options)


def land(spark, path, landing, tmp_path):
    query = ledger.land_with_ledger(captured_messages(spark, path, files_per_trigger=1), landing,
                                    str(tmp_path / "checkpoint"), trigger=None)
    query.awaitTermination()


def steps(make_claims, path, *files):
    for part, rows in enumerate(files):
        write_messages(make_claims(*[
            {"claim_id": i, "submission_timestamp": (START + timedelta(hours=h)).isoformat(), **dict(rest)}
            for i, h, *rest in rows]), path, part)


def counts(spark, landing):
    return [tuple(r)[1:6] for r in ledger.ledger(spark, landing).orderBy("batch").select(
        "batch", "received", "rejected", "late", "repeated", "landed").collect()]


def test_equals_the_batch_job(spark, three_files, tmp_path):  # noqa: F811
    landing = landing_in(tmp_path, run=2)
    land(spark, three_files, landing, tmp_path)
    rows = read_raw_claims(spark, landing.data)
    batch = dedup_claims(normalise(validate(decode_messages(spark.read.parquet(three_files))), AS_OF))
    columns = [c for c in rows.columns if not c.startswith("kafka")]
    assert sorted(map(repr, rows.select(columns).collect())) == sorted(map(repr, batch.select(columns).collect()))
    assert {p.name for p in (tmp_path / "raw").glob("batch=*/region=*")} == {"region=northeast", "region=unknown"}
    assert all(received == sum(rest) for received, *rest in counts(spark, landing))


def test_forgets_and_keeps_late_claims_apart(spark, make_claims, tmp_path):
    path = str(tmp_path / "messages")
    steps(make_claims, path, [("a", 0)], [("a", 1), ("b", 1), ("bad", 1, ("age", 0))], [("c", 72)],
          [("late", 1), ("b", 71), ("d", 73)], [("b", 95), ("c", 96)])
    landing = landing_in(tmp_path, horizon="24 hours", run=2)
    land(spark, path, landing, tmp_path)
    # b came again 70 hours later, when it was forgotten, and once more within the horizon of that
    assert ids(ledger.landed(spark, landing)) == ["a", "b", "b", "c", "d"]
    assert ids(ledger.landed(spark, landing, "late")) == ["late"]
    assert counts(spark, landing) == [(1, 0, 0, 0, 1), (3, 1, 0, 1, 1), (1, 0, 0, 0, 1), (3, 0, 1, 0, 2), (2, 0, 0, 2, 0)]


def test_remembers_for_ever_without_a_horizon(spark, make_claims, tmp_path):
    path = str(tmp_path / "messages")
    steps(make_claims, path, [("a", 0)], [("b", 9000)], [("a", 18000), ("c", 0)], [("b", 0)])
    landing = landing_in(tmp_path, run=1)  # every batch is a run of its own
    land(spark, path, landing, tmp_path)
    assert ids(ledger.landed(spark, landing)) == ["a", "b", "c"]
    assert ids(ledger.landed(spark, landing, "late")) == []


@pytest.mark.parametrize("broken_at", ["ids", "ledger"])
def test_restart_in_the_middle_of_a_batch(spark, make_claims, tmp_path, monkeypatch, broken_at):
    """The second batch fails after its rows are written; taken again, it repeats nothing."""
    path = str(tmp_path / "messages")
    steps(make_claims, path, [("a", 0), ("b", 0)], [("b", 1), ("c", 1)], [("c", 2), ("d", 2)])
    landing = landing_in(tmp_path)
    whole = ledger.Landing.path

    def failing(self, table, batch=None):
        if table == broken_at and batch == 1:
            raise RuntimeError("executor lost")
        return whole(self, table, batch)

    monkeypatch.setattr(ledger.Landing, "path", failing)
    with pytest.raises(Exception, match="executor lost"):
        land(spark, path, landing, tmp_path)
    monkeypatch.setattr(ledger.Landing, "path", whole)
    assert ids(ledger.landed(spark, landing)) == ["a", "b"]
    land(spark, path, landing, tmp_path)
    assert ids(ledger.landed(spark, landing)) == ids(read_raw_claims(spark, landing.data)) == ["a", "b", "c", "d"]
    assert counts(spark, landing) == [(2, 0, 0, 0, 2), (2, 0, 0, 1, 1), (2, 0, 0, 1, 1)]


def test_a_batch_is_taken_once(spark, make_claims, tmp_path):
    path = str(tmp_path / "messages")
    steps(make_claims, path, [("a", 0)])
    landing = landing_in(tmp_path)
    land(spark, path, landing, tmp_path)
    ledger.land_batch(spark.read.parquet(path), 0, landing)
    assert counts(spark, landing) == [(1, 0, 0, 0, 1)]


def test_a_hot_id_crosses_the_shuffle_once_per_task(spark, make_claims, tmp_path):
    """A third of the rows has one id: the map side keeps one row of it."""
    claims = [{"claim_id": "hot" if k % 3 == 0 else f"C{k}", "claim_amount": 100.0 + k} for k in range(300)]
    rows = make_claims(*claims).repartition(4).withColumns(
        {"kafka_ts": F.lit(AS_OF), "kafka_partition": F.lit(0), "kafka_offset": F.col("claim_amount").cast("long")})
    from pyspark.sql import Window
    order = Window.partitionBy("claim_id").orderBy("kafka_ts", "kafka_offset")
    plan = rows.withColumn("_rank", F.row_number().over(order)).where("_rank = 1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    path = str(tmp_path / "messages")
    write_messages(make_claims(*claims), path, 0)
    landing = landing_in(tmp_path)
    land(spark, path, landing, tmp_path)
    assert counts(spark, landing) == [(300, 0, 0, 99, 201)]


def test_no_messages(spark, make_claims, tmp_path):
    path = str(tmp_path / "messages")
    write_messages(make_claims(), path, 0)
    landing = landing_in(tmp_path, horizon="1 day")
    land(spark, path, landing, tmp_path)
    assert ids(ledger.landed(spark, landing)) == []
    assert tuple(ledger.totals(spark, landing).first()) == (0, 0, 0, 0, 0)


def test_arrivals_of_several_files_are_batches(spark, tmp_path, monkeypatch):
    """Every arrival has the same number of files, empty ones where it has few rows, so batches are arrivals."""
    captured = spark.read.parquet(inputs.captured_path(spark, SF))
    monkeypatch.setattr(inputs, "captured_path", lambda *_: str(tmp_path / "captured"))
    year = F.year("timestamp")
    captured.where((year != 1993) | (F.col("offset") % 997 == 0)).repartition(5).write.parquet(str(tmp_path / "captured"))
    size = tables.input_summary(spark, str(tmp_path / "captured")).first()["total_bytes"]
    monkeypatch.setattr(inputs, "BYTES_PER_FILE", size // 3 + 1)
    path = str(tmp_path / "messages")
    for numbers in (range(4), range(4, inputs.ARRIVALS)):
        inputs.append_arrivals(spark, SF, path, numbers)
    files = tables.data_files(spark, path).count()
    assert inputs.arrival_files(spark, SF) == 3 and files == 3 * inputs.ARRIVALS
    taken = []
    captured_messages(spark, path, files_per_trigger=3).writeStream.foreachBatch(lambda rows, batch: taken.extend(
        (batch, r["arrival"], r["n"]) for r in rows.groupBy(inputs.arrival().alias("arrival")).agg(
            F.count("*").alias("n")).collect())).trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "checkpoint")).start().awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "captured")).groupBy(inputs.arrival().alias("arrival")).count()
    assert sorted(taken) == sorted((r["arrival"], r["arrival"], r["count"]) for r in rows.collect())


def test_batches_of_a_backlog_are_bounded(spark, tmp_path, monkeypatch):
    captured = spark.read.parquet(inputs.captured_path(spark, SF)).limit(400)
    monkeypatch.setattr(inputs, "captured_path", lambda *_: str(tmp_path / "captured"))
    captured.repartition(40).write.parquet(str(tmp_path / "captured"))
    monkeypatch.setattr(inputs, "BATCHES", 4)
    sizes = []
    inputs.several_batches(spark, SF).writeStream.foreachBatch(lambda rows, _: sizes.append(rows.count())).trigger(
        availableNow=True).option("checkpointLocation", str(tmp_path / "checkpoint")).start().awaitTermination()
    assert len(sizes) == 4 and sum(sizes) == 400


def test_messages_are_captured_without_a_shuffle_of_their_own(spark, monkeypatch):
    """Neither sorted nor dealt again: they are much larger than the order lines."""
    seen = []
    monkeypatch.setattr(inputs, "stored", lambda _, sf_dir, name, build: seen.append(build) or "")
    monkeypatch.setattr(inputs, "messages", lambda *_: Kept())

    class Kept:
        write = property(lambda self: self)

        def hint(self, *_):
            raise AssertionError("another shuffle")

        def parquet(self, path):
            seen.append(path)

    inputs.captured_path(spark, SF)
    seen[0]("here")
    assert seen[1] == "here"


def test_captured_files_can_be_read_by_several_tasks(spark, tmp_path, monkeypatch):
    """Row groups bound what a task reads; the session's setting holds again afterwards."""
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setattr(inputs, "stored", lambda _, sf_dir, name, build: build(str(tmp_path / name)) or str(tmp_path / name))
    monkeypatch.setattr(inputs, "ROW_GROUP", 64 * 1024)
    inputs.captured_path(spark, SF)
    groups = [pq.ParquetFile(f).num_row_groups for f in glob.glob(str(tmp_path / "captured" / "*.parquet"))]
    assert max(groups) > 1 and spark.conf.get("parquet.block.size", None) is None


def test_whole_rows_are_told_apart(spark):
    from catalog.queries import _whole

    rows = [("a", None, 1.0), (None, "a", 1.0), ("a", "", 1.0), ("", "a", 1.0), ("a", None, None), ("a", None, 2.0),
            ("b", None, 1.0), (None, None, None)]
    frame = spark.createDataFrame([*rows, rows[0]], "x string, y string, z double")
    found = frame.select(*_whole(["x", "y", "z"])).collect()
    assert len(set(found)) == len(rows) and found[0] == found[-1]


def test_arrivals_are_made_in_one_pass(spark, tmp_path, monkeypatch):
    """The captured messages are read once for all arrivals, and nothing is left beside these."""
    captured, reads = inputs.captured_path(spark, SF), []
    log = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths: reads.extend(paths) or log(self, *paths))
    inputs.append_arrivals(spark, SF, str(tmp_path / "messages"), range(inputs.ARRIVALS))
    assert reads.count(captured) == 1 and [p.name for p in tmp_path.iterdir()] == ["messages"]
    passes = [p for p in reads if "-aside-" in p]
    assert len(passes) == 1
    assert log(spark.read, str(tmp_path / "messages")).exceptAll(log(spark.read, captured)).count() == 0
    assert log(spark.read, str(tmp_path / "messages")).count() == log(spark.read, captured).count()
