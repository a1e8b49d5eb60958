"""Splits, class-balanced samples and oversampling.

Hash-based variants depend on the claim id only, so a recomputed partition gives the same rows again."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from claimwright.operators.joins import small_side
from claimwright.operators.quantiles import exact_quantile

# Sampling parameters.
SEED = 42
MAX_RATIO = 5.0
TRAIN_TENTHS = 8
SAMPLE_PER_CLASS = 4000


def id_hash(key: str = "claim_id") -> Column:
    """First 32 bits of the id's MD5 as a number."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def hash_split(df: DataFrame, key: str = "claim_id", train_tenths: int = TRAIN_TENTHS) -> DataFrame:
    """Adds `split`, 'train' or 'test'; all rows of a key fall on the same side."""
    in_train = id_hash(key) % 10 < train_tenths
    return df.withColumn("split", F.when(in_train, "train").otherwise("test"))


def stratified_split(df: DataFrame, label: str = "label", key: str = "claim_id",
                     train_share: float = TRAIN_TENTHS / 10) -> DataFrame:
    """Adds `split` with exactly `ceil(train_share * n)` training rows of each label; rows without one are a
    stratum of their own.

    The cut is an exact quantile of the ids' hash per label: one row per label is joined, no class is gathered or
    sorted in one task."""
    stratum = F.when(F.col(label).isNull(), "none").otherwise(F.concat(F.lit("="), F.col(label).cast("string")))
    hashed = df.withColumn("_hash", F.md5(key)).withColumn("_stratum", stratum)
    cuts = exact_quantile(hashed, "_stratum", "_hash", train_share, F.substring("_hash", 1, 4), "_cut")
    return (
        hashed.join(small_side(cuts), "_stratum", "left")
        .withColumn("split", F.when(F.col("_hash") <= F.col("_cut"), "train").otherwise("test"))
        .drop("_hash", "_cut", "_stratum")
    )


def first_by_hash(df: DataFrame, rows: int, total: int | None = None, key: str = "claim_id") -> DataFrame:
    """The `rows` rows with the smallest id hashes: a sample that does not follow the order of the ids.

    A bound on the hash, derived from the number of rows (`total`, counted if not given), leaves about twice as many
    rows before anything is sorted, so the last task sees no more than that. Should the bound leave too few, which is
    a matter of chance beyond ten standard deviations, the whole table is ranked."""
    total = df.count() if total is None else total
    order = [F.md5(key), F.col(key)]
    share = (2 * rows + 100) / max(total, 1)
    if share >= 1:
        return df.orderBy(*order).limit(rows)
    near = df.filter(id_hash(key) < int(share * 2**32))
    return (near if near.limit(rows).count() == rows else df).orderBy(*order).limit(rows)


def balanced_sample(df: DataFrame, per_class: int = SAMPLE_PER_CLASS, flag: str = "is_fraud",
                    key: str = "claim_id") -> DataFrame:
    """Up to `per_class` rows of each class, lowest id hash first."""
    normal, fraud = by_class(df, flag)
    sizes = df.agg(F.count_if(F.col(flag)), F.count_if(~F.col(flag))).first()
    return first_by_hash(fraud, per_class, sizes[0], key).unionByName(first_by_hash(normal, per_class, sizes[1], key))


def class_ratio(df: DataFrame, flag: str = "is_fraud", max_ratio: float = MAX_RATIO) -> float | None:
    """Normal rows per fraud row, capped; None without fraud rows."""
    row = df.agg(
        F.count_if(F.col(flag)).alias("fraud"), F.count_if(~F.col(flag)).alias("normal")
    ).first()
    return min(row["normal"] / row["fraud"], max_ratio) if row["fraud"] else None


def by_class(df: DataFrame, flag: str = "is_fraud") -> tuple[DataFrame, DataFrame]:
    """Normal and fraud rows; rows without a class are in neither."""
    return df.filter(~F.col(flag)), df.filter(F.col(flag))


def uniform(key: str, seed: int) -> Column:
    """A number in [0, 1) that a row's key and the seed fix."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(key))), 1, 12), 16, 10).cast("double") / 2.0**48


def poisson_steps(mean: float) -> list[float]:
    """Probabilities of at most 0, 1, 2, ... draws, as far as they can be told from 1."""
    steps, term, total = [], math.exp(-mean), 0.0
    while total < 1 - 2.0**-48 and len(steps) < 200:
        total += term
        steps.append(total)
        term *= mean / len(steps)
    return steps


def oversample_poisson(df: DataFrame, flag: str = "is_fraud", max_ratio: float = MAX_RATIO,
                       seed: int = SEED, key: str = "claim_id") -> DataFrame:
    """Fraud rows drawn with replacement up to the class ratio (they replace the originals) and all normal
    rows. How often a row is drawn depends on its key and the seed only; without fraud rows the input comes back
    unchanged."""
    ratio = class_ratio(df, flag, max_ratio)
    if ratio is None:
        return df
    # a column of its own, and no filter on the number: the hash would be worked out again for each step of both
    labelled = df.filter(F.col(flag).isNotNull()).withColumn("_draw", F.when(F.col(flag), uniform(key, seed)))
    copies = sum((F.when(F.col("_draw") >= p, 1).otherwise(0) for p in poisson_steps(ratio)), F.lit(0))
    times = F.when(F.col(flag), copies).otherwise(1)
    # no row for an empty array
    return labelled.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times))).drop("_copy", "_draw")


def oversample_replicated(df: DataFrame, flag: str = "is_fraud", max_ratio: float = MAX_RATIO) -> DataFrame:
    """As `oversample_poisson`, but every fraud row exactly `floor(ratio)` times, at least once.

    Copies are made row by row in one pass, without a shuffle."""
    ratio = class_ratio(df, flag, max_ratio)
    if ratio is None:
        return df
    copies = F.when(F.col(flag), max(int(ratio), 1)).otherwise(1)
    labelled = df.filter(F.col(flag).isNotNull())
    return labelled.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = SEED, key: str = "claim_id") -> DataFrame:
    """Random rows without replacement, by key and seed; all rows for a fraction of 1. A smaller sample is part of a
    larger one."""
    return df if fraction >= 1 else df.filter(uniform(key, seed) < fraction)
