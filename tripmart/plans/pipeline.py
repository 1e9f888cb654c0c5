"""The monthly chain: bronze → silver → gold → monthly aggregate.

Each step is a plain function over versioned tables, so any scheduler can run
it.  Every step is safe to rerun:

* silver: a high-water mark taken from the commit log decides full overwrite
  (empty table) or append of strictly newer bronze rows;
* gold: consumes the silver commits it has not seen yet (its own log records
  the last silver commit consumed) and MERGEs them on ``trip_id``, rewriting
  only the touched months (the very first load is a plain insert: there is
  nothing to join against);
* aggregate: recomputes exactly the months the new gold commits rewrote and
  replaces those partitions — idempotent, unlike adding deltas onto totals.

The original two-newest-snapshots rule is available as ``progress="latest-two"``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType

from ..functions.quality import EXCLUDED_LOCATIONS, PICKUP
from ..operators.aggregate import monthly_borough_agg
from ..operators.clean import clean_trips
from ..operators.enrich import to_gold
from ..operators.merge import dedupe_source, unique_source, upsert
from ..schemas import AGG, GOLD, GOLD_PARTITIONS, SILVER
from ..session import join_path
from ..sources.bronze import raw_glob, read_bronze
from .incremental import late_rows, read_after_watermark
from .read_plan import DELTA, resolve_read_plan
from .versioned import APPEND, REPLACE, VersionedTable, partition_filter

FULL, INCREMENTAL, SKIPPED = "full", "incremental", "skipped"


def silver_partitions(grain: str) -> dict:
    """Hidden partition columns of silver for a grain (``month`` or ``day``)."""
    if grain == "month":
        return {
            "pickup_year": (F.year(PICKUP), IntegerType()),
            "pickup_month": (F.month(PICKUP), IntegerType()),
        }
    if grain == "day":
        return {"pickup_date": (F.to_date(PICKUP), DateType())}
    raise ValueError(f"unknown silver grain {grain!r}")


@dataclass
class StepResult:
    step: str
    mode: str  # full | incremental | skipped
    commit_id: int | None = None
    source_commit: int | None = None
    rows_written: int | None = None
    detail: str = ""
    total_rows: int | None = None  # rows in the table after the step


@dataclass
class Lakehouse:
    """The three versioned tables of one lakehouse root."""

    silver: VersionedTable | None
    gold: VersionedTable | None
    agg: VersionedTable | None

    @classmethod
    def at(
        cls,
        spark: SparkSession,
        root: str | None,
        incremental_col: str = PICKUP,
        silver_grain: str = "month",
        silver_path: str | None = None,
        gold_path: str | None = None,
        agg_path: str | None = None,
    ) -> Lakehouse:
        """Tables under ``root`` (or at the explicit per-table paths).

        Silver is partitioned on a hidden column derived from the pickup time:
        ``month`` (default) or ``day`` (the original day transform).  Month
        partitions hold a well-sized file per month of taxi data; day
        partitions suit feeds with far more rows per day.
        """
        def where(path: str | None, name: str) -> str | None:
            return path or (join_path(root, name) if root else None)

        hidden = silver_partitions(silver_grain)
        locations = {name: where(path, name) for name, path in
                     (("silver", silver_path), ("gold", gold_path), ("agg", agg_path))}
        # A table without a location stays unset (a job may need only one).
        silver = locations["silver"] and VersionedTable(
            spark,
            locations["silver"],
            SILVER,
            partition_by=list(hidden),
            sort_by=[incremental_col],
            derived=hidden,
            watermark_col=incremental_col,
        )
        gold = locations["gold"] and VersionedTable(spark, locations["gold"], GOLD, partition_by=GOLD_PARTITIONS)
        agg = locations["agg"] and VersionedTable(spark, locations["agg"], AGG, partition_by=GOLD_PARTITIONS)
        return cls(silver, gold, agg)

    def require(self, *names: str) -> None:
        missing = [n for n in names if getattr(self, n) is None]
        if missing:
            raise ValueError(f"no location given for table(s) {missing}: pass a lake root or their paths")


def _rows(table: VersionedTable, commit_id: int) -> int | None:
    return next((c.rows for c in table.commits() if c.commit_id == commit_id), None)


def refresh_silver(
    spark: SparkSession,
    bronze: DataFrame | str,
    silver: VersionedTable,
    excluded_locations: Iterable[int] = EXCLUDED_LOCATIONS,
    lookback_days: int | None = None,
) -> StepResult:
    """Clean new bronze rows into silver (full load when silver is empty).

    ``bronze`` is a DataFrame or the raw landing root (``year=*/*.parquet``).
    Late rows at or below the watermark are not reloaded (strict ``>``), unless
    ``lookback_days`` is given: rows of so many days up to the watermark are
    then loaded too when silver does not hold their trip key yet.
    """
    if silver is None:
        raise ValueError("no location given for the silver table")
    col = silver.watermark_col or PICKUP
    if isinstance(bronze, str):
        bronze = read_bronze(spark, raw_glob(bronze))
    watermark = silver.high_water_mark()
    incoming = read_after_watermark(bronze, col, watermark)
    if watermark is not None and lookback_days is not None:
        incoming = incoming.unionByName(late_rows(bronze, silver.as_of(), col, watermark, lookback_days))
    if incoming.isEmpty():
        return StepResult("silver", SKIPPED, detail="no bronze rows after the watermark")
    cleaned = clean_trips(incoming, excluded_locations)
    if watermark is None:
        commit = silver.overwrite(cleaned)
        mode = FULL
    else:
        commit = silver.append(cleaned)
        mode = INCREMENTAL
    return StepResult(
        "silver",
        mode,
        commit,
        rows_written=_rows(silver, commit),
        detail=f"watermark={watermark}",
        total_rows=silver.row_count(),
    )


def _upstream_slice(upstream: VersionedTable, last: int | None, latest: int, progress: str):
    """(mode, frame) of upstream rows to process.

    ``consumer``: every upstream commit after the last one consumed; any
    non-append among them (or a first run) means a full re-read, which the
    idempotent MERGE absorbs.  ``latest-two``: the original rule, looking only
    at the two newest commits, with its full fallback on an empty delta.
    """
    if progress == "latest-two":
        plan = resolve_read_plan(
            upstream.commits_frame(),
            delta_is_empty=lambda a, b: upstream.appended_between(a, b).isEmpty(),
        )
        if plan.mode == DELTA:
            return INCREMENTAL, upstream.appended_between(plan.start_snapshot_id, plan.snapshot_id)
        return FULL, upstream.as_of(plan.snapshot_id)
    # Compactions (replace) keep the content: they are not changes to consume.
    newer = [c for c in upstream.commits() if (last is None or c.commit_id > last) and c.operation != REPLACE]
    if last is None or any(c.operation != APPEND for c in newer):
        return FULL, upstream.as_of(latest)
    if all(c.rows == 0 for c in newer):  # known from the log: nothing was appended
        return SKIPPED, None
    return INCREMENTAL, upstream.appended_between(last, latest)


def refresh_gold(
    spark: SparkSession,
    lake: Lakehouse,
    zones: DataFrame,
    created_at: Column | None = None,
    progress: str = "consumer",
    on_duplicate: str = "error",
    single_precision: bool = False,
    sync_deletes: bool = False,
) -> StepResult:
    """Enrich unseen silver commits and MERGE them into gold on ``trip_id``.

    By default gold only gains and updates rows (a plain MERGE).  With
    ``sync_deletes`` a full re-read (after a silver overwrite or delete)
    replaces gold with the upserted silver contents, so trips removed from
    silver leave gold too; ``created_at`` of surviving trips is kept.
    """
    lake.require("silver", "gold")
    latest = lake.silver.latest_commit_id()
    if latest is None:
        return StepResult("gold", SKIPPED, detail="silver has no commits")
    last = lake.gold.last_source_commit()
    if last == latest:
        return StepResult("gold", SKIPPED, source_commit=latest, detail="silver unchanged")
    mode, silver_rows = _upstream_slice(lake.silver, last, latest, progress)
    if mode == SKIPPED:
        return StepResult("gold", SKIPPED, source_commit=latest, detail="new silver commits are empty")
    incoming = to_gold(silver_rows, zones, created_at=created_at, single_precision=single_precision)
    mirror = sync_deletes and mode == FULL
    order = ["dropoff_datetime", "total_amount"]
    if lake.gold.latest_commit_id() is None:
        # First load: nothing to match against, so MERGE reduces to an insert
        # without a join; only the key check shuffles, and ``insert`` not even that.
        if incoming.isEmpty():
            return StepResult("gold", SKIPPED, source_commit=latest, detail="no rows to merge")
        if on_duplicate == "dedupe":
            incoming = dedupe_source(incoming, ["trip_id"], order)
        elif on_duplicate == "error":
            incoming = unique_source(incoming, ["trip_id"])
        commit = lake.gold.overwrite(incoming, source_commit=latest)
        return StepResult("gold", mode, commit, latest, _rows(lake.gold, commit))
    result = upsert(
        lake.gold.as_of(),
        incoming,
        ["trip_id"],
        preserve=["created_at"],
        scope_cols=None if mirror else GOLD_PARTITIONS,
        on_duplicate=on_duplicate,
        latest_by=order,
        delete_missing=mirror,
    )
    if mirror:
        commit = lake.gold.overwrite(result.merged, source_commit=latest)
    elif not result.scope:
        return StepResult("gold", SKIPPED, source_commit=latest, detail="no rows to merge")
    else:
        commit = lake.gold.replace_partitions(result.merged, result.scope, source_commit=latest)
    return StepResult("gold", mode, commit, latest, _rows(lake.gold, commit))


def refresh_agg(spark: SparkSession, lake: Lakehouse) -> StepResult:
    """Recompute the aggregate for the months gold rewrote since the last run."""
    lake.require("gold", "agg")
    latest = lake.gold.latest_commit_id()
    if latest is None:
        # Nothing to aggregate: keep whatever aggregate exists (no empty overwrite).
        return StepResult("agg", SKIPPED, detail="gold has no commits")
    last = lake.agg.last_source_commit()
    if last == latest:
        return StepResult("agg", SKIPPED, source_commit=latest, detail="gold unchanged")
    months = lake.gold.partitions_since(last) if last is not None else None
    if months == []:  # only compactions since the last run
        return StepResult("agg", SKIPPED, source_commit=latest, detail="gold content unchanged")
    gold = lake.gold.as_of(latest)
    if months is None:
        commit = lake.agg.overwrite(monthly_borough_agg(gold), source_commit=latest)
        return StepResult("agg", FULL, commit, latest, _rows(lake.agg, commit))
    touched = gold.filter(partition_filter(months, GOLD))
    commit = lake.agg.replace_partitions(monthly_borough_agg(touched), months, source_commit=latest)
    return StepResult("agg", INCREMENTAL, commit, latest, _rows(lake.agg, commit))


def run_pipeline(
    spark: SparkSession,
    bronze: DataFrame | str,
    root: str | Lakehouse,
    zones: DataFrame,
    excluded_locations: Iterable[int] = EXCLUDED_LOCATIONS,
    created_at: Column | None = None,
    on_duplicate: str = "error",
    single_precision: bool = False,
    sync_deletes: bool = False,
    lookback_days: int | None = None,
) -> list[StepResult]:
    """clean → load → aggregate, one call per scheduled run; options as in ``refresh_silver`` and ``refresh_gold``."""
    lake = root if isinstance(root, Lakehouse) else Lakehouse.at(spark, root)
    return [
        refresh_silver(spark, bronze, lake.silver, excluded_locations, lookback_days),
        refresh_gold(
            spark,
            lake,
            zones,
            created_at=created_at,
            on_duplicate=on_duplicate,
            single_precision=single_precision,
            sync_deletes=sync_deletes,
        ),
        refresh_agg(spark, lake),
    ]
