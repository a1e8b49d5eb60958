"""Categories to indices, ordered by frequency."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, Window, functions as F

from claimwright.schema import CATEGORY_INDEX


def fit_category_index(claims: DataFrame) -> StringIndexerModel:
    """One indexer for all category columns, fitted in one pass. Unseen and null values get the index after
    the last label."""
    indexer = StringIndexer(
        inputCols=list(CATEGORY_INDEX), outputCols=list(CATEGORY_INDEX.values()), handleInvalid="keep"
    )
    return indexer.fit(claims.select(*CATEGORY_INDEX))


def category_index(claims: DataFrame) -> DataFrame:
    """The same mapping as a relation `(column_name, category, n, idx)`: most frequent first, ties by value.

    The claims are counted by all columns together first; the rows of each column come from those few counts."""
    by_frequency = Window.partitionBy("column_name").orderBy(F.col("n").desc(), "category")
    return (
        claims.groupBy(*CATEGORY_INDEX).agg(F.count("*").alias("_n"))
        .unpivot(["_n"], list(CATEGORY_INDEX), "column_name", "category")
        .filter("category is not null")
        .groupBy("column_name", "category")
        .agg(F.sum("_n").alias("n"))
        .withColumn("idx", (F.row_number().over(by_frequency) - 1).cast("double"))
    )
