"""DataFrame → DataFrame operators: cleaning, enrichment, aggregation, MERGE."""

from .aggregate import merge_partial_aggs, monthly_borough_agg, with_avg_revenue
from .clean import clean_trips, reject_reasons
from .enrich import enrich_with_zones, to_gold
from .joins import bounded_broadcast
from .merge import MergeResult, upsert

__all__ = [
    "MergeResult",
    "bounded_broadcast",
    "clean_trips",
    "enrich_with_zones",
    "merge_partial_aggs",
    "monthly_borough_agg",
    "reject_reasons",
    "to_gold",
    "upsert",
    "with_avg_revenue",
]
