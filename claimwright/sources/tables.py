"""Batch sources and sinks: raw claims, the feature table, reports, the input gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from claimwright.schema import RAW_SCHEMA


class NoInputError(RuntimeError):
    """The input folder is missing or holds no data file."""


def read_raw_claims(spark: SparkSession, path: str) -> DataFrame:
    """Raw claims with their declared schema; a filter on `region` prunes folders. Folders of batches above the
    regions make no difference."""
    return spark.read.schema(RAW_SCHEMA).parquet(path).select([f.name for f in RAW_SCHEMA])


def write_raw_claims(claims: DataFrame, path: str) -> None:
    """Raw claims as Parquet, one folder per region. No shuffle by region: every task writes its own file per
    region, so a region with much of the data is written by all tasks."""
    claims.select([f.name for f in RAW_SCHEMA]).write.mode("overwrite").partitionBy("region").parquet(path)


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Overwrite catalog table `name`, creating its database if needed, and return the table read back.

    With `path` the table's files lie there, so one write serves both readers of the table and of the path."""
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def create_dashboard_views(spark: SparkSession, database: str, feature_table: str, metrics_path: str) -> None:
    """`claim_features_view` and `model_metrics_view`, the relations dashboards query, in `database`."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for view, source in (
        ("claim_features_view", feature_table), ("model_metrics_view", f"parquet.`{metrics_path}`")
    ):
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS SELECT * FROM {source}")


def save_parquet(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a Parquet folder and return it read back: cuts lineage, and gives the planner true sizes."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_report(report: DataFrame, path: str) -> DataFrame:
    """One CSV file with header. Only for reports: aggregated over a bounded key, or limited."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return report.sparkSession.read.schema(report.schema).option("header", True).csv(path)


def save_ordered_report(report: DataFrame, path: str) -> DataFrame:
    """An ordered report of any length as CSV: the files, in the order of their names, are the ranking.

    The sort deals rows by range, and adaptive execution merges ranges, so a short report is one file and a long one is
    written by many tasks. `<path>_manifest` tells each file's rows and the number of its first one."""
    report.write.mode("overwrite").option("header", True).csv(path)
    rows = report.sparkSession.read.schema(report.schema).option("header", True).csv(path)
    files = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n_rows"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files.withColumn("first_row", F.coalesce(F.sum("n_rows").over(before), F.lit(0)) + 1).coalesce(1).write.mode(
        "overwrite").option("header", True).csv(f"{path}_manifest")
    return rows


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file string, n_rows long, first_row long").option("header", True).csv(f"{path}_manifest")


def data_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """`(path, length)` of the data files below `path`; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length")
    )


def require_input(spark: SparkSession, path: str, pattern: str = "*.parquet") -> int:
    """Number of data files below `path`; raises `NoInputError` if there is none."""
    from pyspark.errors import AnalysisException

    try:
        count = data_files(spark, path, pattern).count()
    except AnalysisException as exc:
        raise NoInputError(f"no input folder {path}") from exc
    if count < 1:
        raise NoInputError(f"no data files below {path}")
    return count


def input_summary(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """File count and bytes below `path`, as one row."""
    return data_files(spark, path, pattern).agg(
        F.count("*").alias("data_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")
    )


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of intermediates, in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
