"""Column profile of a table in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, nulls, numeric or text minimum and maximum.

    All columns are aggregated in a single scan; only the one-row result is turned into rows."""
    facts = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        nothing_num, nothing_text = F.lit(None).cast("double"), F.lit(None).cast("string")
        numeric = isinstance(field.dataType, T.NumericType)
        text = isinstance(field.dataType, T.StringType)
        facts.append(F.struct(
            F.lit(field.name).alias("column_name"),
            F.count("*").alias("n_rows"),
            F.count_if(col.isNull()).alias("n_nulls"),
            (F.min(col).cast("double") if numeric else nothing_num).alias("min_number"),
            (F.max(col).cast("double") if numeric else nothing_num).alias("max_number"),
            (F.min(col) if text else nothing_text).alias("min_text"),
            (F.max(col) if text else nothing_text).alias("max_text"),
        ))
    return df.agg(F.array(*facts).alias("facts")).select(F.explode("facts").alias("f")).select("f.*")
