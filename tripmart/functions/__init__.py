"""Column-level building blocks (pure expressions, no actions)."""

from .calendar import calendar_parts
from .keys import trip_id
from .measures import stable_sum
from .quality import clean_predicate, first_failed_rule, global_predicate, rate_rule

__all__ = [
    "calendar_parts",
    "clean_predicate",
    "first_failed_rule",
    "global_predicate",
    "rate_rule",
    "stable_sum",
    "trip_id",
]
