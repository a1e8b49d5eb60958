"""Left joins of claims with per-key statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Statistics of up to this many keys are broadcast (a few MB); the size is checked before the hint is given.
BROADCAST_ROWS = 50_000
# Providers are a key, a count and three numbers each: this many take some 50 MB, and joined by shuffle they would send all
# claims, with all columns, across it.
BROADCAST_PROVIDERS = 500_000
# At most so many keys can be hot: a key is, with at least this part of the rows or of a shuffle partition's share.
HOT_KEYS = 100_000


def small_side(frame: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it has few rows, counted up to the bound only; else as it is, for a shuffled join
    whose skewed partitions adaptive execution splits."""
    return F.broadcast(frame) if frame.limit(broadcast_rows + 1).count() <= broadcast_rows else frame


def with_region_stats(claims: DataFrame, stats: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Claims with their region's statistics, whatever regions there are."""
    return claims.join(small_side(stats, broadcast_rows), "region", "left")


def with_key_stats(claims: DataFrame, stats: DataFrame, key: str, weight: str, spread_by: Column,
                   broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Claims left-joined with one row of statistics per `key`, whatever the number or skew of the keys.

    * Few keys (counted, not assumed): broadcast, no shuffle of the claims.
    * Many keys: the hot ones (row count in `weight`, at most HOT_KEYS keys) are broadcast. The rest is
      joined by shuffle, in which rows already matched, and rows without a key, are spread by a salt that
      depends only on the row. No reducer receives a hot key."""
    # `limit` first: counting stops at the bound
    if stats.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return claims.join(F.broadcast(stats), key, "left")

    partitions = int(claims.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    extra = [c for c in stats.columns if c != key]
    row_total = stats.agg(F.sum(weight)).first()[0] or 0
    # a tenth of a partition's rows, as long as that leaves no more than HOT_KEYS hot keys
    is_hot = F.col(weight) >= row_total / min(10 * partitions, HOT_KEYS)
    hot = stats.filter(is_hot).select(F.col(key).alias("_hot_key"), F.struct(*extra).alias("_hot"))
    # One key column with a marker in front: 'k' and the key for rows still to be matched, 's' and a salt for the
    # others. The two never meet. (A separate salt column, constant on the statistics' side, would not do: the
    # optimizer folds the constant and partitions by the key alone.)
    cold = stats.filter(~is_hot).select(
        F.concat(F.lit("k"), F.col(key).cast("string")).alias("_cold_key"), F.struct(*extra).alias("_cold")
    )
    salt = F.xxhash64(spread_by).cast("string")
    spread = claims.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_key",
        F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), F.concat(F.lit("s"), salt)).otherwise(
            F.concat(F.lit("k"), F.col(key).cast("string"))
        ),
    )
    joined = spread.join(cold, F.col("_key") == F.col("_cold_key"), "left")
    return joined.select(
        key,
        *[c for c in claims.columns if c != key],
        *[F.coalesce(F.col(f"_hot.{c}"), F.col(f"_cold.{c}")).alias(c) for c in extra],
    )


def with_provider_stats(claims: DataFrame, stats: DataFrame, broadcast_rows: int = BROADCAST_PROVIDERS) -> DataFrame:
    """Claims with their provider's statistics; nulls where the provider has none."""
    return with_key_stats(
        claims, stats, "provider_id", "provider_total_claims", F.col("claim_id"), broadcast_rows
    )
