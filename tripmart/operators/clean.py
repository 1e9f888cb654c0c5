"""bronze → silver cleaning (rules F1–F17) and the reject report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import (
    EXCLUDED_LOCATIONS,
    clean_predicate,
    first_failed_rule,
    global_predicate,
    rate_rule,
)
from ..schemas import SILVER_COLUMNS


def apply_global_rules(df: DataFrame, excluded_locations: Iterable[int] = EXCLUDED_LOCATIONS) -> DataFrame:
    """Rules F1–F10 only."""
    return df.filter(global_predicate(excluded_locations))


def apply_rate_rules(df: DataFrame) -> DataFrame:
    """Rules F11–F17 only."""
    return df.filter(rate_rule())


def clean_trips(df: DataFrame, excluded_locations: Iterable[int] = EXCLUDED_LOCATIONS) -> DataFrame:
    """Rows of ``df`` that pass every rule, as the 20 silver columns.

    One combined filter: the plain comparisons become parquet pushed filters,
    the per-rate CASE is evaluated in the same codegen stage.  Nothing is
    cached: the cleaned frame is consumed by exactly one action.
    """
    return df.filter(clean_predicate(excluded_locations)).select(*SILVER_COLUMNS)


def reject_reasons(df: DataFrame, excluded_locations: Iterable[int] = EXCLUDED_LOCATIONS) -> DataFrame:
    """Count of rejected rows per first failing rule: ``(reject_reason, rejected_rows)``.

    A hash aggregate over a handful of labels; the partial (map-side) step
    collapses every task to at most one row per label, so a hot label costs
    nothing extra in the shuffle.
    """
    counts = (
        df.select(first_failed_rule(excluded_locations).alias("reject_reason"))
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )
    # Drop the NULL (kept) group after aggregating.  A plain filter on the key
    # would be pushed below the aggregate into the upstream join condition and
    # evaluate the rule chain twice per row; referencing the count pins it here.
    rejected = F.when(F.col("reject_reason").isNotNull(), F.col("rejected_rows")).otherwise(F.lit(0))
    return counts.filter(rejected > 0)
