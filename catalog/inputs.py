"""Inputs of the registered queries, derived by Spark from the given tables and stored once per session."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import datetime
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from claimwright.ml.training import save_model, train_explained_gbt, train_gbt, train_lr, train_test
from claimwright.operators.evaluation import class_metrics, threshold_predictions, with_label
from claimwright.operators.messages import encode_messages
from claimwright.operators.sampling import hash_split
from claimwright.plans.features import build_features, clean_batch
from claimwright.schema import PROCEDURES
from claimwright.session import settings, shared_dir, sized_shuffles
from claimwright.sources.streams import TOPIC, captured_messages
from claimwright.sources.tables import delete_folder, input_summary, read_raw_claims, save_parquet, write_raw_claims
from claimwright.streaming import ledger
from catalog.tpch import order_lines, source_claims

AS_OF = datetime(2024, 1, 1)
EVENTS_AS_OF = datetime(2024, 1, 31)

_stored: dict[tuple[str, str, str], str] = {}


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/claimwright/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]) -> str:
    """Path of an input that `build(path)` writes on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = new_dir(spark, f"{crc32(sf_dir.encode()):08x}-{name}")
        build(path)
        _stored[key] = path
    return _stored[key]


def order_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the tables that claims are made of, each a file or a folder."""
    return sum(input_summary(spark, f"{sf_dir}/{name}.parquet").first()["total_bytes"] for name in ("lineitem", "orders"))


def claims_path(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        with sized_shuffles(spark, order_bytes(spark, sf_dir)):
            write_raw_claims(clean_batch(source_claims(spark, sf_dir), AS_OF), path)

    return stored(spark, sf_dir, "claims", build)


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw-claims table: validated, normalised, one row per claim."""
    return read_raw_claims(spark, claims_path(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table."""
    path = stored(spark, sf_dir, "features", lambda p: save_parquet(
        build_features(claims(spark, sf_dir), f"{p}-stats"), p))
    return spark.read.parquet(path)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per source claim, duplicates and invalid claims included."""
    return encode_messages(
        source_claims(spark, sf_dir),
        topic=F.lit(TOPIC),
        partition=F.col("kafka_partition"),
        offset=F.col("kafka_offset"),
        timestamp=F.col("kafka_ts"),
    )


#: Bytes of a row group of captured messages. A batch is a few files, and a task reads whole row groups: of the default,
#: as large as a file, a file is read by one task, however many cores wait.
ROW_GROUP = 8 * 1024 * 1024


def captured_path(spark: SparkSession, sf_dir: str) -> str:
    """Messages captured as files, for the streaming source. They are some ten times the order lines they are made of, so
    the tasks that make them write them, without another shuffle."""
    def build(path: str) -> None:
        with settings(spark, parquet__block__size=ROW_GROUP):
            messages(spark, sf_dir).write.parquet(path)

    return stored(spark, sf_dir, "captured", build)


#: Batches of a backlog, at most, if it has more than twice as many files: each batch commits all state and reads what
#: is remembered from those before it.
BATCHES = 16


def several_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured messages, two files at a time, or more where that would be more than BATCHES batches."""
    path = captured_path(spark, sf_dir)
    files = input_summary(spark, path).first()["data_files"]
    return captured_messages(spark, path, files_per_trigger=max(2, -(-files // BATCHES)))


#: Arrivals of a stream that runs for years: one per year of shipping, some messages two years late.
ARRIVALS = 9
#: Captured messages that one task reads when it writes its file of an arrival.
BYTES_PER_FILE = 64 * 1024 * 1024


def arrival() -> Column:
    year = F.least(F.greatest(F.year("timestamp") - 1992, F.lit(0)), F.lit(ARRIVALS - 3))
    return year + F.when(F.floor(F.col("offset") / 8) % 17 == 0, 2).otherwise(0)


def arrival_files(spark: SparkSession, sf_dir: str) -> int:
    """Files of each arrival, as many for one as for another: a batch takes that number of files."""
    return max(1, -(-input_summary(spark, captured_path(spark, sf_dir)).first()["total_bytes"] // BYTES_PER_FILE))


def append_arrivals(spark: SparkSession, sf_dir: str, path: str, numbers: Iterable[int]) -> None:
    """Messages of each arrival as `arrival_files` files, written in that order. A part without rows leaves no file: an
    empty one stands for it.

    The captured messages are read once and set aside by arrival, not read again for each of them. A task has a writer
    for each arrival, of one small row group, so its rows need no sort."""
    numbers = list(numbers)
    rows, files = spark.read.parquet(captured_path(spark, sf_dir)), arrival_files(spark, sf_dir)
    aside = f"{path}-aside-{uuid.uuid4().hex[:12]}"
    with settings(spark, parquet__block__size=ROW_GROUP, spark__sql__maxConcurrentOutputFileWriters=ARRIVALS + 1):
        rows.withColumn("_arrival", arrival()).where(F.col("_arrival").isin(numbers)).write.partitionBy(
            "_arrival").parquet(aside)
    by_arrival = spark.read.schema(T.StructType([*rows.schema, T.StructField("_arrival", T.IntegerType())])).parquet(aside)
    for number in numbers:
        own = by_arrival.where(F.col("_arrival") == number).drop("_arrival")
        own.coalesce(files).write.mode("append").parquet(path)
        for _ in range(files * (number + 1) - input_summary(spark, path).first()["data_files"]):
            spark.createDataFrame([], own.schema).coalesce(1).write.mode("append").parquet(path)
    delete_folder(spark, aside)


def landing(spark: SparkSession, sf_dir: str, path: str) -> ledger.Landing:
    return ledger.Landing(f"{path}/data", f"{path}/state", horizon="400 days", as_of=AS_OF, buckets=16, run=4)


def landed_years(spark: SparkSession, sf_dir: str) -> ledger.Landing:
    """The arrivals landed with a horizon of 400 days, each a batch."""
    def build(path: str) -> None:
        append_arrivals(spark, sf_dir, f"{path}/messages", range(ARRIVALS))
        ledger.land_with_ledger(captured_messages(spark, f"{path}/messages", files_per_trigger=arrival_files(spark, sf_dir)),
                                landing(spark, sf_dir, path), f"{path}/checkpoint", trigger=None).awaitTermination()

    return landing(spark, sf_dir, stored(spark, sf_dir, "landed_years", build))


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are malformed and some hold an age of the wrong type."""
    text = F.col("value").cast("string")
    damaged = F.when(F.col("offset") % 53 == 0, F.concat(F.lit("{bad"), text)).when(
        F.col("offset") % 59 == 0, F.regexp_replace(text, '"age":[0-9]+', '"age":"x"')
    ).otherwise(text)
    return messages(spark, sf_dir).withColumn("value", damaged.cast("binary"))


def insurance_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """The claims as an insurance CSV, smoker as yes/no in mixed case."""
    days = F.col("days_since_last_claim")
    smoker = F.when(F.col("smoker"), F.when(days % 2 == 0, "Yes").otherwise("YES")).otherwise(
        F.when(days % 2 == 0, "no").otherwise("No")
    )
    rows = claims(spark, sf_dir).select(
        "age", "sex", "bmi", "children", smoker.alias("smoker"), "region", F.col("claim_amount").alias("charges")
    )
    return stored(spark, sf_dir, "insurance", lambda path: rows.write.option("header", True).csv(path))


def cms_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """Order lines as a CMS extract."""
    cust, part = F.col("o_custkey"), F.col("l_partkey")
    codes = F.array(*[F.lit(c) for c in (*PROCEDURES, "G0008", "J3301")])
    born = F.date_add(F.lit("1930-01-01").cast("date"), ((cust * 7919) % 20000).cast("int"))
    rows = order_lines(spark, sf_dir).select(
        F.concat(F.lit("C"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("CLM_ID"),
        F.concat(F.lit("P"), cust).alias("DESYNPUF_ID"),
        F.date_format(born, "yyyyMMdd").alias("BENE_BIRTH_DT"),
        (cust % 3 + 1).cast("string").alias("BENE_SEX_IDENT_CD"),
        F.col("l_extendedprice").alias("CLM_PMT_AMT"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("CLM_FROM_DT"),
        (F.col("l_suppkey") + 1000000000).cast("string").alias("AT_PHYSN_NPI"),
        F.element_at(codes, (part % 12 + 1).cast("int")).alias("HCPCS_CD"),
        F.concat(F.lit("V"), part % 90 + 10).alias("ICD9_DGNS_CD_1"),
    )
    return stored(spark, sf_dir, "cms", lambda path: rows.write.option("header", True).csv(path))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as timed, flagged rows."""
    return as_flagged(spark.read.parquet(f"{sf_dir}/events.parquet"))


def as_flagged(rows: DataFrame) -> DataFrame:
    return rows.select(
        "event_id", F.col("ts").cast("timestamp").alias("ingestion_ts"),
        (F.col("event_type") == "error").alias("is_fraud"),
    )


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_predictions(features(spark, sf_dir))


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the threshold rule for each year of claims, stamped at the year's end, as model `gbt`, and as
    model `logistic_regression` a sixteenth lower at the same times."""
    yearly = rule_predictions(spark, sf_dir).filter("submission_ts is not null").withColumn(
        "year", F.year("submission_ts")
    )
    names = ["f1", "precision", "recall", "accuracy", "auc_roc"]
    # a rule of one threshold: the area is the mean of the two rates
    rate = {label: F.avg(F.when(F.col("label") == label, (F.col("prediction") == label).cast("double")))
            for label in (0, 1)}
    area = yearly.groupBy("year").agg(((rate[0] + rate[1]) / 2).alias("auc_roc"))
    values = class_metrics(yearly, "year").join(area, "year").unpivot(["year"], names, "metric_name", "metric_value")
    models = F.explode(F.array(F.struct(F.lit("gbt").alias("model"), F.lit(0.0).alias("less")),
                               F.struct(F.lit("logistic_regression").alias("model"), F.lit(0.0625).alias("less"))))
    return values.select("*", models.alias("m")).select(
        "m.model", "metric_name", (F.round("metric_value", 4) - F.col("m.less")).alias("metric_value"),
        F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)).cast("timestamp").alias("run_ts"),
    )


def test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows of the split."""
    return hash_split(with_label(features(spark, sf_dir))).filter("split = 'test'").drop("split")


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows as they are."""
    return train_test(features(spark, sf_dir), oversample=lambda rows: rows)[0]


def train_path(spark: SparkSession, sf_dir: str) -> str:
    """Oversampled training rows."""
    return stored(spark, sf_dir, "train", lambda path: train_test(features(spark, sf_dir))[0].write.parquet(path))


def gbt_path(spark: SparkSession, sf_dir: str) -> str:
    train = train_path(spark, sf_dir)
    return stored(spark, sf_dir, "gbt", lambda path: save_model(train_gbt(spark.read.parquet(train)), path))


def lr_path(spark: SparkSession, sf_dir: str) -> str:
    train = train_path(spark, sf_dir)
    return stored(spark, sf_dir, "lr", lambda path: save_model(train_lr(spark.read.parquet(train)), path))


def explained_gbt_path(spark: SparkSession, sf_dir: str) -> str:
    train = train_path(spark, sf_dir)
    return stored(spark, sf_dir, "explained_gbt", lambda path: save_model(
        train_explained_gbt(spark.read.parquet(train)), path))
