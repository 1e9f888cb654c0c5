"""File-driven bronze → silver ingestion with Structured Streaming.

The batch job decides what is new with a timestamp high-water mark, so a late
file whose trips are older than the newest silver trip is skipped.  A file
stream instead remembers which *files* it has processed (in its checkpoint),
so every landed file is cleaned exactly once regardless of its timestamps.

``trigger(availableNow=True)`` processes everything landed since the last run
and stops, so the stream runs on the same monthly schedule as the batch jobs.
Each micro-batch goes through the same cleaning rules and is appended to the
versioned silver table; the batch id is stored as the commit's source, which
makes a replayed batch (after a failure between commit and checkpoint) a no-op.

Limit: a file stream reads every file with the one bronze schema.  A missing
column arrives as NULL, but a file storing a column with a different physical
type (e.g. int64 location ids) fails the batch; land such files through the
batch reader (``sources.bronze.read_bronze``), which groups and casts them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..functions.quality import EXCLUDED_LOCATIONS
from ..plans.pipeline import Lakehouse, refresh_agg, refresh_gold
from ..operators.clean import clean_trips
from ..schemas import BRONZE
from ..session import join_path
from ..sources.bronze import raw_glob


def bronze_stream(spark: SparkSession, bronze_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over landed raw files (fixed bronze schema)."""
    reader = spark.readStream.schema(BRONZE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(raw_glob(bronze_root))


def ingest_available(
    spark: SparkSession,
    bronze_root: str,
    lake_root: str,
    zones: DataFrame | None = None,
    excluded_locations: Iterable[int] = EXCLUDED_LOCATIONS,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int | None = None,
) -> int:
    """Clean every not-yet-seen landed file into silver; optionally refresh gold/agg.

    Returns the number of micro-batches committed to silver in this run.
    """
    lake = Lakehouse.at(spark, lake_root)
    excluded = list(excluded_locations)
    checkpoint = checkpoint_location or join_path(lake_root, "_checkpoints", "bronze_stream")
    committed: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        silver = Lakehouse.at(spark, lake_root).silver  # fresh view of the commit log
        # Batch ids start again with each checkpoint, whose query id stays with it: both name a batch.
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        batch_id += zlib.crc32(query_id.encode()) << 31
        if any(c.source_commit == batch_id for c in silver.commits()):
            return  # replay of a batch that already committed
        cleaned = clean_trips(batch, excluded)
        if silver.latest_commit_id() is None:
            silver.overwrite(cleaned, source_commit=batch_id)
        else:
            silver.append(cleaned, source_commit=batch_id)
        committed.append(batch_id)

    query = (
        bronze_stream(spark, bronze_root, max_files_per_trigger)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if zones is not None and committed:
        refresh_gold(spark, lake, zones)
        refresh_agg(spark, Lakehouse.at(spark, lake_root))
    return len(committed)
