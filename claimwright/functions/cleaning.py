"""Column expressions that bring raw claim values into their domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from claimwright.schema import UNKNOWN


def in_domain(col: Column, domain: Sequence[str], other: str = UNKNOWN) -> Column:
    """Trimmed lower-case value if listed in `domain`, else `other` (also for null)."""
    cleaned = F.lower(F.trim(col))
    return F.when(cleaned.isin(list(domain)), cleaned).otherwise(other)


def capped(col: Column, upper: float) -> Column:
    """`col` limited from above; null stays null (`least` would turn it into the limit)."""
    return F.when(col > upper, F.lit(float(upper))).otherwise(col)


def clamped(col: Column, lower: float, upper: float) -> Column:
    """`col` limited on both sides; null stays null."""
    return F.when(col < lower, F.lit(float(lower))).when(col > upper, F.lit(float(upper))).otherwise(col)


def parsed_timestamp(text: Column) -> Column:
    """ISO text to timestamp, null where it does not parse (in ANSI mode too)."""
    return F.try_to_timestamp(text)


def share_pct(part: Column, whole: Column) -> Column:
    """`100 * part / whole`, two decimals, as a double; null when `whole` is 0."""
    return F.round(F.try_divide(part.cast("double") * 100, whole), 2)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.when(condition, 1).otherwise(0).cast("int")
