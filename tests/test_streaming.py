"""File-stream ingestion: each landed file is cleaned once, late files included."""

import datetime as dt

from helpers import T0, trips_df
from tripmart.plans.pipeline import Lakehouse
from tripmart.schemas import ZONES
from tripmart.streaming import ingest_available


def land(spark, root, year, start, n):
    rows = [
        dict(
            tpep_pickup_datetime=T0 + dt.timedelta(minutes=start + i),
            tpep_dropoff_datetime=T0 + dt.timedelta(minutes=start + i + 10),
        )
        for i in range(n)
    ]
    trips_df(spark, rows).coalesce(1).write.mode("append").parquet(f"{root}/year={year}")


def test_stream_picks_up_late_files(spark, tmp_root):
    raw, lake_root = f"{tmp_root}/raw", f"{tmp_root}/lake"
    zones = spark.createDataFrame([(100, "Manhattan", "Midtown", "Y")], ZONES)
    land(spark, raw, 2024, 100, 3)
    assert ingest_available(spark, raw, lake_root, zones) == 1
    # A late file whose trips are older than everything in silver.
    land(spark, raw, 2023, 0, 2)
    assert ingest_available(spark, raw, lake_root, zones) == 1
    assert ingest_available(spark, raw, lake_root, zones) == 0  # nothing new
    lake = Lakehouse.at(spark, lake_root)
    assert lake.silver.as_of().count() == 5
    assert lake.gold.as_of().count() == 5
    assert sum(r.total_trips for r in lake.agg.as_of().collect()) == 5


def test_a_new_checkpoint_starts_its_batches_again(spark, tmp_root):
    first, second, lake_root = f"{tmp_root}/raw1", f"{tmp_root}/raw2", f"{tmp_root}/lake"
    land(spark, first, 2024, 0, 2)
    land(spark, second, 2024, 50, 2)
    land(spark, second, 2024, 90, 2)
    assert ingest_available(spark, first, lake_root, checkpoint_location=f"{tmp_root}/a", max_files_per_trigger=1) == 1
    assert ingest_available(spark, second, lake_root, checkpoint_location=f"{tmp_root}/b", max_files_per_trigger=1) == 2
    assert Lakehouse.at(spark, lake_root).silver.as_of().count() == 6
