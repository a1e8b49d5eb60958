"""Jobs for spark-submit: `spark-submit claimwright/jobs.py JOB ...`, or `python -m claimwright.jobs JOB ...`."""

from __future__ import annotations

import argparse
import os
import signal
import sys
from collections.abc import Sequence

if __package__ in (None, ""):  # run as a file
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession

from claimwright.plans import benchmarks, reports, workflow
from claimwright.session import build_session, size_shuffles
from claimwright.sources.streams import OFFSETS_PER_TRIGGER, TOPIC, captured_messages, kafka_messages
from claimwright.sources.tables import input_summary, require_input
from claimwright.streaming.ingest import TRIGGER
from claimwright.streaming.ledger import Landing, land_with_ledger, totals


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Messages to the raw-claims folder, until stopped; or, with --once, all that is there now."""
    if args.captured:
        messages = captured_messages(spark, args.captured)
    else:
        messages = kafka_messages(
            spark, args.servers, args.topic, starting=args.starting or ("earliest" if args.once else "latest"),
            offsets_per_trigger=args.offsets_per_trigger, min_partitions=args.min_partitions,
            fail_on_data_loss=not args.accept_data_loss,
        )
    landing = Landing(args.raw, args.state or f"{args.checkpoint.rstrip('/')}-ledger", horizon=args.horizon)
    query = land_with_ledger(messages, landing, args.checkpoint, trigger=None if args.once else args.trigger)
    stop = lambda *_: query.stop()  # noqa: E731  a batch in work is finished or taken again after a restart
    before = {s: signal.signal(s, stop) for s in (signal.SIGTERM, signal.SIGINT)}
    try:
        query.awaitTermination()
    finally:
        for number, handler in before.items():
            signal.signal(number, handler)
        totals(spark, landing).show()


def _sized(spark: SparkSession, path: str) -> None:
    """Shuffles sized by the data files below a path."""
    size_shuffles(spark, input_summary(spark, path).first()["total_bytes"])


def _config(args: argparse.Namespace) -> workflow.RunConfig:
    return workflow.RunConfig(
        raw_path=args.raw, output_path=args.output, run_id=args.run_id, feature_table=args.table,
        search=not args.no_search,
    )


def features(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Raw claims to the feature table; shows its summary."""
    require_input(spark, args.raw)
    _sized(spark, args.raw)
    return workflow.dataset_summary(workflow.build_feature_table(spark, _config(args)))


def train(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Both models from the feature table; shows their metrics."""
    _sized(spark, f"{args.output}/features")
    return workflow.train_models(spark.table(args.table), _config(args))


def explain(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Attributions of the stored model; shows the importance of the features."""
    _sized(spark, f"{args.output}/features")
    return workflow.explain_model(spark, _config(args))


def report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """All reports as CSV; shows their row counts."""
    _sized(spark, f"{args.output}/features")
    return reports.run_reports(spark.table(args.table), f"{args.output}/reports")


def benchmark(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The scaling workload over the feature table; the others are timed by bench.py."""
    return benchmarks.scaling(spark.table(args.table))


def retrain(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The whole run; shows its report."""
    return workflow.run_pipeline(spark, _config(args)).orderBy("line_no").select("text")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="claimwright")
    jobs = top.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("ingest", help=ingest.__doc__)
    job.set_defaults(run=ingest)
    source = job.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--captured", help="folder of captured messages instead of Kafka")
    job.add_argument("--topic", default=TOPIC)
    job.add_argument("--starting", help="default: latest, and earliest with --once")
    job.add_argument("--min-partitions", type=int)
    job.add_argument("--accept-data-loss", action="store_true", help="go on where the topic has lost offsets")
    job.add_argument("--offsets-per-trigger", type=int, default=OFFSETS_PER_TRIGGER)
    job.add_argument("--raw", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--state", help="ledger, late claims and remembered ids; default: beside the checkpoint")
    job.add_argument("--trigger", default=TRIGGER)
    job.add_argument("--horizon", help="forget claim ids after this event time, e.g. '30 days'")
    job.add_argument("--once", action="store_true")
    for run in (features, train, explain, report, benchmark, retrain):
        job = jobs.add_parser(run.__name__, help=run.__doc__)
        job.set_defaults(run=run)
        job.add_argument("--raw", help="raw-claims folder", required=run in (features, retrain))
        job.add_argument("--output", help="output folder", required=run is not benchmark)
        job.add_argument("--table", default=workflow.FEATURE_TABLE)
        job.add_argument("--run-id", default="manual")
        job.add_argument("--no-search", action="store_true", help="fixed parameters instead of the grid search")
    top.add_argument("--hive", action="store_true", help="use the Hive catalog")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or build_session(f"claimwright-{args.job}", hive=args.hive)
    shown = args.run(spark, args)
    if shown is not None:
        shown.show(50, truncate=False)


if __name__ == "__main__":
    main()
