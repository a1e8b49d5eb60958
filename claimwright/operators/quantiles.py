"""Exact discrete quantiles per group without bringing a group together in one task."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright.operators.joins import small_side


def _at_rank(counts: DataFrame, group: str, order: str, rank: Column) -> DataFrame:
    """Rows of a small count table in which the running count reaches `rank`; `_k` is the rank within."""
    running = Window.partitionBy(group).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    upto = counts.withColumn("_upto", F.sum("_n").over(running)).withColumn("_target", rank)
    return upto.filter((F.col("_upto") >= F.col("_target")) & (F.col("_upto") - F.col("_n") < F.col("_target"))) \
        .withColumn("_k", F.col("_target") - F.col("_upto") + F.col("_n"))


def exact_quantile(df: DataFrame, group: str, value: str, q: float, bucket: Column, name: str) -> DataFrame:
    """Value at rank `ceil(q * n)` of each group, as `(group, name)`.

    `bucket` must be a bounded, order-preserving coarsening of `value`. Pass one counts rows per bucket
    (combined on the map side) and finds the bucket that holds the rank; pass two counts the distinct values of
    that one bucket. Each window sees bucket counts or one bucket's values, never a group's rows."""
    values = df.select(group, value, bucket.alias("_b")).filter(
        F.col(value).isNotNull() & F.col(group).isNotNull()
    )
    per_bucket = values.groupBy(group, "_b").agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(group))
    # decimal arithmetic: 0.95 * 20 is 19, not a hair above it
    target = F.greatest(F.lit(1), F.ceil(F.lit(Decimal(str(q))) * total)).cast("long")
    hit = _at_rank(per_bucket, group, "_b", target).select(group, "_b", "_k")

    # one row for each group
    inside = values.join(small_side(hit.withColumnRenamed("_k", "_rank")), [group, "_b"])
    per_value = inside.groupBy(group, value, "_rank").agg(F.count("*").alias("_n"))
    return _at_rank(per_value, group, value, F.col("_rank")).select(group, F.col(value).alias(name))
