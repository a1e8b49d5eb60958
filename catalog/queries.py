"""The registered queries: name -> callable of (spark, directory of the given tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from catalog import inputs as src
from claimwright.functions.features import ENGINEERED
from claimwright.functions.rules import EXPECTED_FRAUD_PCT, any_rule, expected_charge, fraud_rules, fraud_signatures
from claimwright.functions.cleaning import share_pct
from claimwright.ml import attribution, training, trees
from claimwright.operators import evaluation, sampling
from claimwright.operators.dedup import dedup_claims
from claimwright.operators.indexing import category_index
from claimwright.operators.joins import with_provider_stats, with_region_stats
from claimwright.operators.messages import decode_messages, encode_messages
from claimwright.operators.profile import profile
from claimwright.operators.stats import provider_stats, region_stats
from claimwright.operators.validation import normalise, reject_counts, validate
from claimwright.plans import benchmarks, reports, workflow
from claimwright.schema import CATEGORY_INDEX, CLAIM_SCHEMA, FEATURES, RAW_SCHEMA
from claimwright.session import DEFAULTS
from claimwright.sources import external, tables
from claimwright.sources.streams import captured_messages
from catalog.tpch import source_claims
from claimwright.streaming import hourly, ingest, ledger

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

CLAIM_COLUMNS = [f.name for f in CLAIM_SCHEMA]
# What all messages of one claim id agree on, whichever of them a stream meets first.
STABLE = ["claim_id", "patient_id", "age", "sex", "children", "smoker", "region", "days_since_last_claim"]
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Weights of the linear attribution checked against SQL.
LINEAR_WEIGHTS = {name: (i + 1) / 100 for i, name in enumerate(FEATURES)}


def query(named: str | Query):
    """Register a query under its function's name, or under the name given."""
    if callable(named):
        QUERIES[named.__name__] = named
        return named

    def register(function: Query) -> Query:
        QUERIES[named] = function
        return function

    return register


def text(column: str):
    """A timestamp as ISO text."""
    return F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss").alias(column)


def landed(spark: SparkSession, stream: DataFrame, name: str, **options) -> DataFrame:
    """Run a stream over all that is available, its state on disk, and read back what it wrote."""
    out, before = src.new_dir(spark, name), spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, DEFAULTS[STATE_STORE])  # a stream keeps the settings it starts with
    try:
        handle = ingest.land_stream(stream, f"{out}/data", f"{out}/checkpoint", trigger=None, **options)
    finally:
        spark.conf.set(STATE_STORE, before)
    handle.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


# --- sources --------------------------------------------------------------------------------------------


@query
def stream_source_files(spark, sf_dir):
    stream = captured_messages(spark, src.captured_path(spark, sf_dir)).select("topic", "partition", "offset")
    return landed(spark, stream, "stream_source", partition_by=None).groupBy("topic", "partition").agg(
        F.count("*").alias("messages"), F.max("offset").alias("last_offset")
    )


@query
def decode_json_claims(spark, sf_dir):
    # columns with nulls as doubles and text, whose nulls look alike in every client
    decoded = decode_messages(src.broken_messages(spark, sf_dir)).withColumns({
        **{c: F.col(c).cast("double") for c in ("age", "children", "days_since_last_claim")},
        **{c: F.col(c).cast("string") for c in ("smoker", "is_fraud")},
    })
    return decoded.select(*CLAIM_COLUMNS, text("kafka_ts"), "kafka_offset", "kafka_partition")


@query
def decode_event_props(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.k")


@query
def encode_roundtrip(spark, sf_dir):
    sent = src.messages(spark, sf_dir)
    return decode_messages(sent).select(*CLAIM_COLUMNS)


@query
def scan_raw_claims(spark, sf_dir):
    return src.claims(spark, sf_dir).select(
        *[c for c in CLAIM_COLUMNS if c != "submission_timestamp"],
        "kafka_offset", "kafka_partition", text("kafka_ts"), text("submission_ts"), text("ingestion_ts"),
    )


@query
def map_insurance_csv(spark, sf_dir):
    return external.insurance_to_claims(external.read_insurance_csv(spark, src.insurance_csv_path(spark, sf_dir)))


@query
def map_cms_claims(spark, sf_dir):
    return external.cms_to_claims(external.read_cms_csv(spark, src.cms_csv_path(spark, sf_dir)))


@query
def cms_rule_labels(spark, sf_dir):
    """CMS claims as complete claims, labelled by the rules."""
    rows = external.cms_to_claims(external.read_cms_csv(spark, src.cms_csv_path(spark, sf_dir)))
    return external.with_rule_label(external.complete_claims(rows)).select(
        "claim_id", "provider_id", "claim_amount", F.col("bmi").cast("string").alias("bmi"), "is_fraud")


@query
def insurance_claims(spark, sf_dir):
    """Insurance rows as complete claims, through validation as far as their fields allow."""
    rows = external.insurance_to_claims(external.read_insurance_csv(spark, src.insurance_csv_path(spark, sf_dir)))
    claims = external.complete_claims(rows).withColumn("patient_id", F.col("claim_id"))
    return normalise(validate(claims), src.AS_OF).select(
        "age", "sex", "bmi", "children", "smoker", "region", "claim_amount",
        F.col("days_since_last_claim").cast("string").alias("days_since_last_claim"))


# --- sinks ----------------------------------------------------------------------------------------------


@query
def feature_table_roundtrip(spark, sf_dir):
    path = src.new_dir(spark, "feature_table")
    name = "claims_check.features_" + path.rsplit("-", 1)[1]
    saved = tables.save_table(src.features(spark, sf_dir), name, path)
    by_path = spark.read.parquet(path).select("claim_id", F.col("anomaly_score_proxy").alias("score_by_path"))
    return saved.select(
        "claim_id", "provider_id", "charge_per_age", "bmi_category", "anomaly_score_proxy", "sex_idx"
    ).join(by_path, "claim_id")


@query
def report_csv_roundtrip(spark, sf_dir):
    report = reports.region_fraud_patterns(src.features(spark, sf_dir))
    return tables.save_report(report, src.new_dir(spark, "report_csv"))


@query
def confusion_matrix_pivot(spark, sf_dir):
    return evaluation.confusion_table(src.rule_predictions(spark, sf_dir))


@query
def retraining_report(spark, sf_dir):
    return reports.retraining_report(
        src.metric_history(spark, sf_dir), run_id="weekly", run_ts=datetime(2024, 1, 8, 2)
    )


# --- projections, filters -------------------------------------------------------------------------------


@query
def validate_claims(spark, sf_dir):
    return normalise(validate(source_claims(spark, sf_dir)), src.AS_OF).select(
        *CLAIM_COLUMNS, text("submission_ts"), text("ingestion_ts")
    )


@query
def rejected_claims(spark, sf_dir):
    return reject_counts(source_claims(spark, sf_dir))


@query
def fraud_only_count(spark, sf_dir):
    return src.features(spark, sf_dir).filter("is_fraud").agg(F.count("*").alias("fraud_claims"))


@query
def labelled_claims(spark, sf_dir):
    return evaluation.with_label(src.claims(spark, sf_dir)).select("claim_id", "is_fraud", "label")


@query
def features_filled(spark, sf_dir):
    days = F.col("days_since_last_claim")
    holes = src.features(spark, sf_dir).withColumns({
        "bmi": F.when(days % 7 != 0, F.col("bmi")),
        "charge_per_age": F.when(days % 5 != 0, F.col("charge_per_age")),
        "age": F.when(days % 3 != 0, F.col("age")),
    })
    return attribution.fill_features(holes).select("claim_id", "bmi", "charge_per_age", "age")


# --- joins and statistics -------------------------------------------------------------------------------


def _providers(spark, sf_dir):
    path = src.stored(spark, sf_dir, "providers", lambda p: tables.save_parquet(
        provider_stats(src.claims(spark, sf_dir)), p))
    return spark.read.parquet(path)


def _rounded(df, columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


PROVIDER_DOUBLES = ["provider_avg_claim", "provider_max_claim", "provider_fraud_rate"]
REGION_DOUBLES = ["region_avg_claim", "region_stddev_claim", "region_p95_claim"]


@query
def claims_with_provider_stats(spark, sf_dir):
    joined = with_provider_stats(src.claims(spark, sf_dir), _providers(spark, sf_dir))
    return _rounded(joined.select("claim_id", "provider_id", "provider_total_claims", *PROVIDER_DOUBLES),
                    PROVIDER_DOUBLES)


@query
def claims_with_provider_stats_shuffled(spark, sf_dir):
    """The same join without a broadcast of all providers."""
    joined = with_provider_stats(src.claims(spark, sf_dir), _providers(spark, sf_dir), broadcast_rows=0)
    return _rounded(joined.select("claim_id", "provider_id", "provider_total_claims", *PROVIDER_DOUBLES),
                    PROVIDER_DOUBLES)


@query
def claims_with_region_stats(spark, sf_dir):
    # a region outside the known ones has statistics as well
    moved = F.when(F.col("days_since_last_claim") % 11 == 0, "midwest").otherwise(F.col("region"))
    claims = src.claims(spark, sf_dir).withColumn("region", moved)
    joined = with_region_stats(claims, region_stats(claims))
    return _rounded(joined.select("claim_id", "region", *REGION_DOUBLES), REGION_DOUBLES)


@query("provider_stats")
def provider_stats_by_provider(spark, sf_dir):
    return _rounded(provider_stats(src.claims(spark, sf_dir)), PROVIDER_DOUBLES)


@query("region_stats")
def region_stats_by_region(spark, sf_dir):
    return _rounded(region_stats(src.claims(spark, sf_dir)), REGION_DOUBLES)



@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(src.rule_predictions(spark, sf_dir))


@query
def dataset_summary(spark, sf_dir):
    return workflow.dataset_summary(src.features(spark, sf_dir))


@query
def mean_abs_by_feature(spark, sf_dir):
    return attribution.mean_absolute(src.features(spark, sf_dir), {f: f for f in FEATURES})


@query("dedup_claims")
def dedup_claims_batch(spark, sf_dir):
    cleaned = normalise(validate(source_claims(spark, sf_dir)), src.AS_OF)
    return dedup_claims(cleaned).select(*CLAIM_COLUMNS)



@query
def latest_model_metric(spark, sf_dir):
    # two models have the metric at one time
    return reports.latest_metric(src.metric_history(spark, sf_dir), "auc_roc")


@query("category_index")
def category_index_table(spark, sf_dir):
    return category_index(src.features(spark, sf_dir))



@query
def union_by_class(spark, sf_dir):
    normal, fraud = sampling.by_class(src.claims(spark, sf_dir))
    return normal.unionByName(fraud).select("claim_id", "is_fraud")


# --- sampling -------------------------------------------------------------------------------------------


@query
def oversample_poisson(spark, sf_dir):
    return sampling.oversample_poisson(src.claims(spark, sf_dir)).select("claim_id", "is_fraud")


@query
def oversample_replicated(spark, sf_dir):
    return sampling.oversample_replicated(src.claims(spark, sf_dir)).select("claim_id", "is_fraud")


@query
def hash_split(spark, sf_dir):
    return sampling.hash_split(src.claims(spark, sf_dir)).select("claim_id", "split")


@query
def balanced_sample(spark, sf_dir):
    return sampling.balanced_sample(src.features(spark, sf_dir)).select(
        "claim_id", "is_fraud", "claim_amount", "anomaly_score_proxy"
    )


@query
def stratified_split(spark, sf_dir):
    # a third label, and none, are strata too
    days = F.col("days_since_last_claim")
    rows = evaluation.with_label(src.features(spark, sf_dir)).withColumn(
        "label", F.when(days % 13 == 0, 2).when(days % 17 != 0, F.col("label")).cast("double"))
    return sampling.stratified_split(rows).select("claim_id", "label", "split")


# --- features, labels -----------------------------------------------------------------------------------


@query
def engineered_features(spark, sf_dir):
    return _rounded(src.features(spark, sf_dir).select("claim_id", *ENGINEERED),
                    ["log_claim_amount", "claim_zscore_region"], 6)


@query
def indexed_categoricals(spark, sf_dir):
    return src.features(spark, sf_dir).select("claim_id", *CATEGORY_INDEX.values())


@query("expected_charge")
def expected_charge_per_claim(spark, sf_dir):
    return src.claims(spark, sf_dir).select("claim_id", F.round(expected_charge(), 4).alias("expected_charge"))



@query
def fraud_rule_flags(spark, sf_dir):
    return src.features(spark, sf_dir).withColumns(fraud_rules()).select("claim_id", *fraud_rules())


@query
def rule_labels(spark, sf_dir):
    return src.features(spark, sf_dir).select("claim_id", any_rule(fraud_rules()).alias("rule_label"))


@query
def fraud_rate_check(spark, sf_dir):
    low, high = EXPECTED_FRAUD_PCT
    rate = share_pct(F.count_if(any_rule(fraud_rules())), F.count("*"))
    return src.features(spark, sf_dir).agg(rate.alias("fraud_pct")).withColumn(
        "as_expected", F.col("fraud_pct").between(low, high)
    )


@query("fraud_signatures")
def fraud_signatures_per_claim(spark, sf_dir):
    return src.claims(spark, sf_dir).select(
        "claim_id", F.concat_ws(",", fraud_signatures()).alias("signatures")
    )



# --- reports, panels, benchmark workloads ---------------------------------------------------------------


def _on_features(function) -> Query:
    return lambda spark, sf_dir: function(src.features(spark, sf_dir))


for _report in (
    *reports.REPORTS.values(), reports.total_claims, reports.overall_fraud_rate, reports.avg_fraud_claim,
    reports.fraud_rate_by_region, reports.top_suspicious_claims,
):
    QUERIES[_report.__name__] = _on_features(_report)


@query
def threshold_status(spark, sf_dir):
    return reports.threshold_status(src.features(spark, sf_dir), src.metric_history(spark, sf_dir))


@query
def run_all_reports(spark, sf_dir):
    return reports.run_reports(src.features(spark, sf_dir), src.new_dir(spark, "reports"))


@query
def procedure_report_written(spark, sf_dir):
    """The report of an unbounded key as it was written: its rows, each with its place by the manifest."""
    path = src.new_dir(spark, "ordered_report")
    rows = tables.save_ordered_report(reports.procedure_code_fraud_analysis(src.features(spark, sf_dir)), path)
    files = tables.read_manifest(spark, path)
    placed = rows.select("*", F.col("_metadata.file_name").alias("file")).join(F.broadcast(files), "file")
    within = Window.partitionBy("file").orderBy(F.desc("fraud_rate_pct"), "procedure_code", "procedure_description")
    return placed.withColumn("place", F.row_number().over(within) + F.col("first_row") - 1).drop(
        "file", "n_rows", "first_row")


@query
def claims_over_time(spark, sf_dir):
    rows = reports.claims_over_time(src.events(spark, sf_dir), src.EVENTS_AS_OF)
    return rows.select(text("time"), "normal_claims", "fraud_claims")


QUERIES["bench_full_scan_count"] = _on_features(benchmarks.full_scan_count)
QUERIES["bench_filter_project"] = _on_features(benchmarks.filter_project)


@query
def bench_group_by(spark, sf_dir):
    return _rounded(benchmarks.group_by(src.features(spark, sf_dir)), ["avg_claim"])


@query
def bench_join_provider_stats(spark, sf_dir):
    return benchmarks.join_provider_average(src.features(spark, sf_dir)).agg(
        F.count("*").alias("num_records"), F.count("p_avg").alias("matched")
    )


@query
def bench_scaling(spark, sf_dir):
    return _rounded(benchmarks.scaling(src.features(spark, sf_dir)), ["avg_amount"])


# --- streaming ------------------------------------------------------------------------------------------


def _whole(columns):
    """128 bits of a row's columns, their nulls included: a hash of them in order and one backwards."""
    marked = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(*marked).alias("whole"), F.xxhash64(F.lit(len(columns)), *marked[::-1]).alias("backwards")


@query
def stream_ingest_claims(spark, sf_dir):
    path = src.new_dir(spark, "stream_ingest")
    landing = ledger.Landing(f"{path}/data", f"{path}/state", as_of=src.AS_OF, run=2)
    ledger.land_with_ledger(src.several_batches(spark, sf_dir), landing, f"{path}/checkpoint", trigger=None).awaitTermination()
    rows = ledger.landed(spark, landing)
    # whichever message of a claim came first: the whole row is one of the claim's rows
    whole = _whole([f.name for f in RAW_SCHEMA])
    candidates = normalise(validate(decode_messages(src.messages(spark, sf_dir))), src.AS_OF).select(*whole).distinct()
    found = rows.select(*STABLE, *whole).join(
        candidates.withColumn("is_candidate", F.lit(True)), ["whole", "backwards"], "left")
    return found.select(*STABLE, F.coalesce("is_candidate", F.lit(False)).alias("is_candidate"))


@query
def stream_dedup_global(spark, sf_dir):
    stream = validate(decode_messages(src.several_batches(spark, sf_dir)))
    return landed(spark, ingest.dedup_stream(stream).select("claim_id", "patient_id"), "dedup_global",
                  partition_by=None)


def _landed(rows: DataFrame) -> DataFrame:
    return rows.select("claim_id", "claim_amount", text("submission_ts"), text("kafka_ts"), "kafka_offset", "region", "batch")


@query
def stream_dedup_watermark(spark, sf_dir):
    """Nine batches and a horizon of some two of them: ids are forgotten and land again."""
    return _landed(ledger.landed(spark, src.landed_years(spark, sf_dir)))


@query
def stream_late_claims(spark, sf_dir):
    """What came behind the watermark, in its own table."""
    return _landed(ledger.landed(spark, src.landed_years(spark, sf_dir), "late"))


@query
def stream_batch_ledger(spark, sf_dir):
    return ledger.ledger(spark, src.landed_years(spark, sf_dir)).select(
        "batch", "received", "rejected", "late", "repeated", "landed", text("newest"), text("watermark"))


@query
def stream_restarted(spark, sf_dir):
    """A query on a processing-time trigger, stopped and started again from its checkpoint while messages come in."""
    path = src.new_dir(spark, "restarted")
    landing, files = src.landing(spark, sf_dir, path), src.arrival_files(spark, sf_dir)
    for numbers in (range(4), range(4, src.ARRIVALS)):
        src.append_arrivals(spark, sf_dir, f"{path}/messages", numbers)
        running = ledger.land_with_ledger(captured_messages(spark, f"{path}/messages", files_per_trigger=files), landing,
                                          f"{path}/checkpoint", trigger="1 second")
        try:
            running.processAllAvailable()
        finally:
            running.stop()
    rows = ledger.landed(spark, landing).agg(
        F.count("*").alias("rows"), F.countDistinct("claim_id").alias("claims"),
        F.countDistinct("batch").cast("long").alias("batches"))
    return ledger.totals(spark, landing).crossJoin(F.broadcast(rows))  # one row each


@query
def stream_hourly_counts(spark, sf_dir):
    # a pattern, as the streaming source takes folders and patterns but not the path of one file
    table = f"{sf_dir}/events*.parquet"
    stream = spark.readStream.schema(spark.read.parquet(table).schema).parquet(table)
    counts = hourly.hourly_counts(src.as_flagged(stream))
    return landed(spark, counts, "hourly", partition_by=None).select(
        text("time"), "normal_claims", "fraud_claims"
    )


# --- models ---------------------------------------------------------------------------------------------


def _gbt(spark, sf_dir):
    return PipelineModel.load(src.gbt_path(spark, sf_dir))


def _scored(spark, sf_dir):
    return _gbt(spark, sf_dir).transform(src.test_rows(spark, sf_dir))


def _explained(spark, sf_dir):
    scored = _gbt(spark, sf_dir).transform(evaluation.with_label(src.features(spark, sf_dir)))
    return attribution.tree_shap(scored, src.gbt_path(spark, sf_dir))


@query
def gbt_train(spark, sf_dir):
    weights = _gbt(spark, sf_dir).stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(f, float(w)) for f, w in zip(FEATURES, weights)], "feature string, importance double"
    )


def _search(spark, sf_dir):
    """Folder of the grid search's results and out-of-fold scores."""
    def build(path: str) -> None:
        found = training.cross_validate_gbt(src.train_rows(spark, sf_dir), path=path)
        spark.createDataFrame(
            training.cv_results(found), "maxIter int, maxDepth int, mean_auc double, is_best boolean"
        ).write.parquet(f"{path}/results")

    return src.stored(spark, sf_dir, "search", build)


@query
def gbt_cv(spark, sf_dir):
    return spark.read.parquet(f"{_search(spark, sf_dir)}/results")


@query
def out_of_fold_scores(spark, sf_dir):
    """Each training row has one score for each combination, from the fold it is held out in."""
    scores = spark.read.parquet(f"{_search(spark, sf_dir)}/scores")
    return scores.groupBy("combination", "fold").agg(
        F.count("score").alias("n_rows"), F.countDistinct("claim_id").alias("n_claims"), F.sum("label").alias("n_fraud"))


@query
def cv_folds(spark, sf_dir):
    """Folds of the grid search, drawn by claim."""
    return training.with_fold(src.train_rows(spark, sf_dir)).select("claim_id", "fold")


@query
def lr_train(spark, sf_dir):
    weights = attribution.linear_weights(PipelineModel.load(src.lr_path(spark, sf_dir)))
    return spark.createDataFrame(list(weights.items()), "feature string, weight double")


@query
def predict(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "claim_id", "label", "prediction", vector_to_array("probability")[1].alias("prob_fraud")
    )


@query
def predict_as_expression(spark, sf_dir):
    """The stored ensemble as CASE expressions against the model's own scores: rows where they differ."""
    margin = trees.margin_expression(trees.tree_nodes(spark, src.gbt_path(spark, sf_dir)), FEATURES)
    rows = _scored(spark, sf_dir).withColumn("margin", margin)
    own = vector_to_array("rawPrediction")[1]
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if((F.col("margin") > 0).cast("double") != F.col("prediction")).alias("other_prediction"),
        F.count_if(~F.coalesce(F.abs(F.col("margin") - own) < 1e-9, F.lit(False))).alias("other_margin"))


@query
def lr_gradient(spark, sf_dir):
    """The gradient of the fitted logistic regression's loss: no term is away from 0."""
    model = PipelineModel.load(src.lr_path(spark, sf_dir))
    rows = training.lr_gradient(spark.read.parquet(src.train_path(spark, sf_dir)), model)
    return rows.select("term", (F.abs("gradient") < 1e-3).alias("is_zero"))


@query
def model_metrics(spark, sf_dir):
    run_ts = datetime(2024, 1, 8, 2)
    linear = PipelineModel.load(src.lr_path(spark, sf_dir)).transform(src.test_rows(spark, sf_dir))
    return training.evaluate(_scored(spark, sf_dir), "gbt", run_ts).unionByName(
        training.evaluate(linear, "logistic_regression", run_ts)
    )


@query
def prediction_sample(spark, sf_dir):
    return training.prediction_sample(_scored(spark, sf_dir))


@query
def model_roundtrip(spark, sf_dir):
    model = _gbt(spark, sf_dir)
    again = training.save_model(model, src.new_dir(spark, "model"))
    rows = src.test_rows(spark, sf_dir)
    first = model.transform(rows).select("claim_id", F.col("rawPrediction").alias("first"))
    second = again.transform(rows).select("claim_id", F.col("rawPrediction").alias("second"))
    differs = vector_to_array("first") != vector_to_array("second")
    return first.join(second, "claim_id").agg(
        F.count("*").alias("n_rows"), F.count_if(differs).alias("different")
    )


@query
def unusable_rows(spark, sf_dir):
    return training.unusable_rows(src.features(spark, sf_dir))


@query
def threshold_rule_predictions(spark, sf_dir):
    return src.rule_predictions(spark, sf_dir).select("claim_id", "label", "prediction")


@query
def binary_auc(spark, sf_dir):
    found = evaluation.exact_auc(src.rule_predictions(spark, sf_dir), "anomaly_score_proxy", src.new_dir(spark, "ranks"))
    return _rounded(found, ["auc_roc", "auc_pr"])


@query
def auc_by_procedure(spark, sf_dir):
    """Claim amounts as a score, by procedure: nearly every score is distinct."""
    rows = src.rule_predictions(spark, sf_dir).select("label", "claim_amount", "procedure_code")
    found = evaluation.exact_auc(rows, "claim_amount", src.new_dir(spark, "ranks"), "procedure_code")
    return _rounded(found, ["auc_roc", "auc_pr"], 6)


@query
def multiclass_metrics(spark, sf_dir):
    return _rounded(evaluation.class_metrics(src.rule_predictions(spark, sf_dir)),
                    ["f1", "precision", "recall", "accuracy"])


@query
def split_accuracy(spark, sf_dir):
    return _rounded(evaluation.split_accuracy(sampling.hash_split(src.rule_predictions(spark, sf_dir))),
                    ["accuracy"])


# --- explanation ----------------------------------------------------------------------------------------


@query
def tree_nodes(spark, sf_dir):
    return trees.tree_nodes(spark, src.gbt_path(spark, sf_dir))


@query
def tree_shap(spark, sf_dir):
    return _explained(spark, sf_dir).select("claim_id", "base_value", *[f"shap_{f}" for f in FEATURES])


@query
def tree_shap_additivity(spark, sf_dir):
    total = F.col("base_value")
    for f in FEATURES:
        total = total + F.col(f"shap_{f}")
    gap = F.abs(total - vector_to_array("rawPrediction")[1])
    return _explained(spark, sf_dir).agg(
        F.count("*").alias("n_rows"), F.count_if(gap > 1e-9).alias("not_additive")
    )


@query
def explained_gbt_additivity(spark, sf_dir):
    """The ensemble that is meant for explanation: its attributions add up to its margin."""
    path = src.explained_gbt_path(spark, sf_dir)
    scored = PipelineModel.load(path).transform(evaluation.with_label(src.features(spark, sf_dir)))
    total = F.col("base_value")
    for f in FEATURES:
        total = total + F.col(f"shap_{f}")
    gap = F.abs(total - vector_to_array("rawPrediction")[1])
    return attribution.tree_shap(scored, path).agg(
        F.count("*").alias("n_rows"), F.count_if(gap > 1e-9).alias("not_additive"))


@query
def tree_walk(spark, sf_dir):
    """The node relation walked from the roots by a recursive query: every node is reached once, no deeper than the
    trees may be, and the training rows of a node are those of its children."""
    nodes = tables.save_parquet(trees.tree_nodes(spark, src.gbt_path(spark, sf_dir)), src.new_dir(spark, "nodes"))
    return spark.sql("""
        WITH RECURSIVE walk(tree_id, node_id, depth, n_rows, left_child, right_child) AS (
          SELECT tree_id, node_id, 0, n_rows, left_child, right_child FROM {nodes} WHERE node_id = 0
          UNION ALL
          SELECT n.tree_id, n.node_id, w.depth + 1, n.n_rows, n.left_child, n.right_child
          FROM walk w JOIN {nodes} n ON n.tree_id = w.tree_id AND n.node_id IN (w.left_child, w.right_child)),
        children AS (
          SELECT w.tree_id, w.node_id, any_value(w.n_rows) AS n_rows, sum(c.n_rows) AS below
          FROM walk w JOIN {nodes} c ON c.tree_id = w.tree_id AND c.node_id IN (w.left_child, w.right_child)
          GROUP BY w.tree_id, w.node_id)
        SELECT (SELECT count(DISTINCT tree_id) FROM walk) AS n_trees,
          (SELECT count(*) FROM {nodes}) - (SELECT count(*) FROM walk) AS not_reached,
          (SELECT count_if(depth > 5) FROM walk) AS too_deep,
          (SELECT count_if(n_rows <> below) FROM children) AS wrong_rows""", nodes=nodes)


@query
def linear_shap(spark, sf_dir):
    explained = attribution.linear_shap(src.features(spark, sf_dir), LINEAR_WEIGHTS)
    columns = [f"shap_{f}" for f in FEATURES]
    return _rounded(explained.select("claim_id", *columns), columns)


@query
def global_importance(spark, sf_dir):
    return attribution.global_importance(attribution.linear_shap(src.features(spark, sf_dir), LINEAR_WEIGHTS))


@query
def attribution_sample(spark, sf_dir):
    return attribution.attribution_sample(_explained(spark, sf_dir))


@query
def dependence_data(spark, sf_dir):
    # of the columns, those that are read again
    path = src.stored(spark, sf_dir, "explained", lambda p: tables.save_parquet(
        _explained(spark, sf_dir).select(*FEATURES, *[f"shap_{f}" for f in FEATURES]), p))
    explained = spark.read.parquet(path)
    top = attribution.top_features(attribution.global_importance(explained))
    return attribution.dependence_bins(explained, [row["feature"] for row in top.collect()])


@query
def dependence_rows(spark, sf_dir):
    """Every claim is in one bin of each feature."""
    bins = dependence_data(spark, sf_dir).groupBy("feature").agg(F.sum("n").alias("n"))
    return bins.agg(F.count("*").alias("n_features"), F.min("n").alias("fewest"), F.max("n").alias("most"))


# --- quality, workflow ----------------------------------------------------------------------------------


@query
def input_file_gate(spark, sf_dir):
    path = src.claims_path(spark, sf_dir)
    tables.require_input(spark, path)
    return tables.input_summary(spark, path)


@query
def claims_profile(spark, sf_dir):
    return profile(src.claims(spark, sf_dir))


@query
def retrain_workflow(spark, sf_dir):
    """The whole run, with the whole grid."""
    out = src.new_dir(spark, "workflow")
    return workflow.run_pipeline(spark, workflow.RunConfig(
        raw_path=src.claims_path(spark, sf_dir), output_path=out, run_id="weekly",
        feature_table="claims_check.retrain_" + out.rsplit("-", 1)[1],
    ))
