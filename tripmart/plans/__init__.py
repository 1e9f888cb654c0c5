"""Table versions, read decisions and the chained jobs built on them."""

from .pipeline import Lakehouse, StepResult, refresh_agg, refresh_gold, refresh_silver, run_pipeline
from .read_plan import ReadPlan, resolve_read_plan
from .versioned import VersionedTable

__all__ = [
    "Lakehouse",
    "ReadPlan",
    "StepResult",
    "VersionedTable",
    "refresh_agg",
    "refresh_gold",
    "refresh_silver",
    "resolve_read_plan",
    "run_pipeline",
]
