"""Which slice of an upstream versioned table a downstream job should read.

Rule (per newest commit): no commits → nothing; a single commit, or a newest
commit whose operation rewrites data (overwrite / delete / replace) → full read
as of that commit; otherwise the rows appended since the previous commit, and
if that delta turns out empty, a full read after all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .versioned import COMMIT_COL, DELETE, OVERWRITE, REPLACE

# Operations that force a full re-read downstream.
REWRITING_OPERATIONS = (OVERWRITE, DELETE, REPLACE)
NONE, FULL, DELTA = "none", "full", "delta"


@dataclass(frozen=True)
class ReadPlan:
    mode: str  # none | full | delta
    snapshot_id: int | None = None  # commit to read (full) or end of range (delta)
    start_snapshot_id: int | None = None  # exclusive start of a delta range

    @property
    def is_incremental(self) -> bool:
        return self.mode == DELTA


def read_mode(operation: Column, previous_id: Column, delta_rows: Column | None = None) -> Column:
    """The full/delta decision as a Column over one commit and its predecessor."""
    full = previous_id.isNull() | operation.isin(list(REWRITING_OPERATIONS))
    if delta_rows is not None:
        full = full | (F.coalesce(delta_rows, F.lit(0)) == 0)
    return F.when(full, F.lit(FULL)).otherwise(F.lit(DELTA))


def read_plans(log: DataFrame, delta_rows: DataFrame | None = None) -> DataFrame:
    """For every commit taken as "newest": the read plan a consumer would get.

    ``log`` has ``(commit_id, operation, committed_at)``; ``delta_rows`` (optional)
    has ``(commit_id, rows)`` = rows appended by that commit.  Commit logs are
    metadata (one row per commit), so the un-partitioned window over them is a
    single small task.
    """
    commits = log.groupBy(COMMIT_COL).agg(
        F.first("operation").alias("operation"), F.max("committed_at").alias("committed_at")
    )
    order = Window.orderBy(F.col("committed_at"), F.col(COMMIT_COL))
    with_prev = commits.withColumn("previous_id", F.lag(COMMIT_COL).over(order))
    rows_col = None
    if delta_rows is not None:
        with_prev = with_prev.join(delta_rows.withColumnRenamed("rows", "delta_rows"), COMMIT_COL, "left")
        rows_col = F.col("delta_rows")
    mode = read_mode(F.col("operation"), F.col("previous_id"), rows_col)
    return with_prev.select(
        F.col(COMMIT_COL).alias("snapshot_id"),
        "operation",
        mode.alias("read_mode"),
        F.when(mode == DELTA, F.col("previous_id")).alias("start_snapshot_id"),
        F.col(COMMIT_COL).alias("end_snapshot_id"),
    )


def resolve_read_plan(log: DataFrame, delta_is_empty=None) -> ReadPlan:
    """The plan for the newest commit of ``log`` (driver-side, ≤ 1 row collected).

    ``delta_is_empty(start, end)`` is called only for a delta plan; when it
    reports no rows the plan falls back to a full read.
    """
    newest = read_plans(log).orderBy(F.col("end_snapshot_id").desc()).limit(1).collect()
    if not newest:
        return ReadPlan(NONE)
    row = newest[0]
    if row.read_mode == DELTA:
        start, end = int(row.start_snapshot_id), int(row.end_snapshot_id)
        if delta_is_empty is not None and delta_is_empty(start, end):
            return ReadPlan(FULL, end)
        return ReadPlan(DELTA, end, start)
    return ReadPlan(FULL, int(row.end_snapshot_id))
