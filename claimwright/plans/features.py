"""From messages to raw claims, and from raw claims to the feature table."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame

from claimwright.functions.features import category_columns, engineered_columns
from claimwright.operators.dedup import dedup_claims
from claimwright.operators.indexing import fit_category_index
from claimwright.operators.joins import with_provider_stats, with_region_stats
from claimwright.operators.stats import provider_stats, region_stats
from claimwright.operators.validation import normalise, validate
from claimwright.schema import RAW_SCHEMA
from claimwright.sources.tables import save_parquet


def clean_batch(claims: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Decoded claims, validated, normalised and deduplicated: the raw-claims table of a batch."""
    deduped = dedup_claims(normalise(validate(claims), as_of))
    return deduped.select([f.name for f in RAW_SCHEMA])


def engineer(claims: DataFrame, providers: DataFrame, regions: DataFrame) -> DataFrame:
    """Claims with provider and region statistics and the fourteen engineered columns."""
    joined = with_region_stats(with_provider_stats(claims, providers), regions)
    return joined.withColumns(engineered_columns())


def category_model(claims: DataFrame) -> StringIndexerModel:
    """Indexer of the category columns. Categories need no statistics, so fitting reads the claims only."""
    return fit_category_index(claims.withColumns(category_columns()))


def build_features(claims: DataFrame, work_path: str) -> DataFrame:
    """The feature table's rows, over written statistics.

    The statistics are aggregated once and stored, so the wide pass over the claims neither repeats them nor
    guesses their size. `claims` should be a stored table: it is read for the statistics, the categories
    (a few columns each) and the features."""
    providers = save_parquet(provider_stats(claims), f"{work_path}/provider_stats")
    regions = save_parquet(region_stats(claims), f"{work_path}/region_stats")
    return category_model(claims).transform(engineer(claims, providers, regions))
