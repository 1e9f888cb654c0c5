"""bronze → silver → gold → agg: full load, increments, reruns, late rows, drift."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import T0, trips_df
from tripmart.plans.pipeline import Lakehouse, refresh_agg, refresh_gold, refresh_silver, run_pipeline
from tripmart.schemas import ZONES
from tripmart.sources.bronze import read_bronze, raw_glob, schema_drift, list_files

ZONE_ROWS = [(100, "Manhattan", "Midtown", "Y"), (200, "Queens", "JFK", "A")]


def zones(spark):
    return spark.createDataFrame(ZONE_ROWS, ZONES)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def batch(spark, start, n, **overrides):
    rows = [
        dict(
            tpep_pickup_datetime=at(start + i),
            tpep_dropoff_datetime=at(start + i + 10),
            VendorID=1 + i % 2,
            **overrides,
        )
        for i in range(n)
    ]
    return trips_df(spark, rows)


def step_modes(results):
    return [r.mode for r in results]


def test_full_then_incremental_then_rerun(spark, tmp_root):
    lake = Lakehouse.at(spark, tmp_root)
    z = zones(spark)
    first = batch(spark, 0, 5)
    assert step_modes(
        [refresh_silver(spark, first, lake.silver), refresh_gold(spark, lake, z), refresh_agg(spark, lake)]
    ) == ["full", "full", "full"]
    assert lake.silver.high_water_mark() == at(4)

    both = first.unionByName(batch(spark, 100, 3))
    res = [refresh_silver(spark, both, lake.silver), refresh_gold(spark, lake, z), refresh_agg(spark, lake)]
    assert step_modes(res) == ["incremental", "incremental", "incremental"]
    assert res[0].rows_written == 3 and res[0].total_rows == 8
    assert lake.gold.as_of().count() == 8
    agg = lake.agg.as_of().collect()
    assert sum(r.total_trips for r in agg) == 8

    # Rerun with nothing new: every step is a no-op.
    rerun = [refresh_silver(spark, both, lake.silver), refresh_gold(spark, lake, z), refresh_agg(spark, lake)]
    assert step_modes(rerun) == ["skipped", "skipped", "skipped"]
    assert sum(r.total_trips for r in lake.agg.as_of().collect()) == 8


def test_watermark_is_strict(spark, tmp_root):
    lake = Lakehouse.at(spark, tmp_root)
    refresh_silver(spark, batch(spark, 0, 1), lake.silver)
    wm = lake.silver.high_water_mark()
    same = trips_df(spark, [dict(tpep_pickup_datetime=wm, tpep_dropoff_datetime=at(50), VendorID=2)])
    later = trips_df(
        spark,
        [dict(tpep_pickup_datetime=wm + dt.timedelta(microseconds=1), tpep_dropoff_datetime=at(50), VendorID=2)],
    )
    assert refresh_silver(spark, same, lake.silver).mode == "skipped"
    assert refresh_silver(spark, later, lake.silver).rows_written == 1


def test_all_rejected_and_empty_inputs(spark, tmp_root):
    lake = Lakehouse.at(spark, tmp_root)
    empty = batch(spark, 0, 0)
    assert refresh_silver(spark, empty, lake.silver).mode == "skipped"
    assert refresh_gold(spark, lake, zones(spark)).mode == "skipped"
    assert refresh_agg(spark, lake).mode == "skipped"
    bad = batch(spark, 0, 3, total_amount=-1.0)
    assert refresh_silver(spark, bad, lake.silver).rows_written == 0


def test_gold_keeps_created_at_and_zone_misses(spark, tmp_root):
    lake = Lakehouse.at(spark, tmp_root)
    z = zones(spark)
    refresh_silver(spark, batch(spark, 0, 2, PULocationID=7), lake.silver)
    refresh_gold(spark, lake, z, created_at=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    first = {r.trip_id: r.created_at for r in lake.gold.as_of().collect()}
    # Re-deliver the same trips plus one new: created_at of the old ones survives.
    refresh_silver(spark, batch(spark, 0, 3, PULocationID=7), lake.silver)  # only minute 2 is new
    refresh_gold(spark, lake, z, created_at=F.lit("2024-06-01 00:00:00").cast("timestamp"))
    gold = lake.gold.as_of().collect()
    assert len(gold) == 3
    assert all(r.created_at == first[r.trip_id] for r in gold if r.trip_id in first)
    assert all(r.pickup_borough is None and r.dropoff_borough == "Queens" for r in gold)
    agg = lake.agg
    refresh_agg(spark, lake)
    rows = agg.as_of().collect()
    assert len(rows) == 1 and rows[0].pickup_borough is None and rows[0].total_trips == 3


def test_incremental_equals_full_recompute(spark, tmp_root):
    z = zones(spark)
    inc = Lakehouse.at(spark, f"{tmp_root}/inc")
    full = Lakehouse.at(spark, f"{tmp_root}/full")
    parts = [batch(spark, 0, 4), batch(spark, 50, 4, DOLocationID=100), batch(spark, 2000, 4)]
    acc = parts[0]
    for i, part in enumerate(parts):
        acc = part if i == 0 else acc.unionByName(part)
        run_pipeline(spark, acc, f"{tmp_root}/inc", z)
    run_pipeline(spark, acc, f"{tmp_root}/full", z)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(inc.agg.as_of().collect(), key=key) == sorted(full.agg.as_of().collect(), key=key)
    assert inc.gold.as_of().count() == full.gold.as_of().count() == 12


def test_latest_two_rule_is_available(spark, tmp_root):
    lake = Lakehouse.at(spark, tmp_root)
    z = zones(spark)
    refresh_silver(spark, batch(spark, 0, 2), lake.silver)
    assert refresh_gold(spark, lake, z, progress="latest-two").mode == "full"
    refresh_silver(spark, batch(spark, 0, 4), lake.silver)
    assert refresh_gold(spark, lake, z, progress="latest-two").mode == "incremental"
    assert lake.gold.as_of().count() == 4


def test_column_names_match_whatever_their_case(spark, tmp_root):
    root = f"{tmp_root}/raw"
    batch(spark, 0, 2).withColumnRenamed("Airport_fee", "airport_fee").withColumn(
        "airport_fee", F.lit(3).cast("bigint")
    ).coalesce(1).write.parquet(f"{root}/year=2023")
    batch(spark, 10, 2).coalesce(1).write.parquet(f"{root}/year=2024")
    report = {r.column: r for r in schema_drift(spark, list_files(spark, raw_glob(root))).collect()}
    assert "airport_fee" not in report
    assert (report["Airport_fee"].drift, report["Airport_fee"].files) == ("retyped", 2)
    fees = [r.Airport_fee for r in read_bronze(spark, raw_glob(root)).collect()]
    assert len(fees) == 4 and fees.count(3.0) >= 2


def test_bronze_files_with_missing_column_and_int64_ids(spark, tmp_root):
    root = f"{tmp_root}/raw"
    batch(spark, 0, 2).drop("cbd_congestion_fee").coalesce(1).write.parquet(f"{root}/year=2023")
    batch(spark, 10, 2).withColumn("PULocationID", F.col("PULocationID").cast("bigint")).coalesce(1).write.parquet(
        f"{root}/year=2024"
    )
    batch(spark, 20, 2).coalesce(1).write.parquet(f"{root}/year=2025")
    df = read_bronze(spark, raw_glob(root))
    assert "year" not in df.columns
    rows = df.collect()
    assert len(rows) == 6
    assert sum(r.cbd_congestion_fee is None for r in rows) == 2
    assert {r.PULocationID for r in rows} == {100}
    drift = {r.column: r.drift for r in schema_drift(spark, list_files(spark, raw_glob(root))).collect()}
    assert drift["cbd_congestion_fee"] == "missing" and drift["PULocationID"] == "retyped"
    assert drift["VendorID"] == "ok"
    # A NULL fee drops rate-1 trips in silver (the rule's NULL semantics).
    lake = Lakehouse.at(spark, f"{tmp_root}/lake")
    assert refresh_silver(spark, root, lake.silver).rows_written == 4


def test_day_grain_partitions(spark, tmp_root):
    lake = Lakehouse.at(spark, tmp_root, silver_grain="day")
    refresh_silver(spark, batch(spark, 0, 3), lake.silver)
    assert lake.silver.as_of().count() == 3
    assert "pickup_date" not in lake.silver.as_of().columns


def test_silver_delete_reaches_gold_only_when_synced(spark, tmp_root):
    z = zones(spark)
    for sync, expected in ((False, 4), (True, 3)):
        lake = Lakehouse.at(spark, f"{tmp_root}/{sync}")
        refresh_silver(spark, batch(spark, 0, 4), lake.silver)
        refresh_gold(spark, lake, z)
        created = {r.trip_id: r.created_at for r in lake.gold.as_of().collect()}
        lake.silver.delete_where(F.col("tpep_pickup_datetime") == at(0))
        res = refresh_gold(spark, lake, z, sync_deletes=sync)
        assert res.mode == "full"
        gold = lake.gold.as_of().collect()
        assert len(gold) == expected
        assert all(r.created_at == created[r.trip_id] for r in gold)
        refresh_agg(spark, lake)
        assert sum(r.total_trips for r in lake.agg.as_of().collect()) == expected


def test_typed_empty_results(spark, tmp_root):
    from tripmart.operators.aggregate import empty_agg, high_water_mark
    from tripmart.schemas import AGG

    lake = Lakehouse.at(spark, tmp_root)
    assert refresh_agg(spark, lake).mode == "skipped"  # no gold: nothing is overwritten
    assert lake.agg.as_of().schema == AGG == empty_agg(spark).schema
    assert lake.agg.as_of().count() == 0
    empty = batch(spark, 0, 0)
    assert high_water_mark(empty, "tpep_pickup_datetime").first().watermark is None


def test_duplicate_trip_keys_fail_the_merge_or_dedupe(spark, tmp_root):
    import pytest

    z = zones(spark)
    twins = trips_df(spark, [{"total_amount": 10.0}, {"total_amount": 12.0}])  # same trip_id
    lake = Lakehouse.at(spark, f"{tmp_root}/strict")
    refresh_silver(spark, twins, lake.silver)
    with pytest.raises(Exception, match="duplicate"):
        refresh_gold(spark, lake, z)
    assert lake.gold.latest_commit_id() is None  # nothing half-written
    lake = Lakehouse.at(spark, f"{tmp_root}/dedupe")
    refresh_silver(spark, twins, lake.silver)
    refresh_gold(spark, lake, z, on_duplicate="dedupe")
    assert [r.total_amount for r in lake.gold.as_of().collect()] == [12.0]
    steps = run_pipeline(spark, twins, f"{tmp_root}/insert", z, on_duplicate="insert")
    assert [s.rows_written for s in steps] == [2, 2, 1]


def test_compaction_keeps_content_and_is_not_reprocessed(spark, tmp_root, capsys):
    from tripmart.plans.read_plan import FULL, resolve_read_plan

    z = zones(spark)
    lake = Lakehouse.at(spark, tmp_root)
    for start in (0, 100, 200):
        refresh_silver(spark, batch(spark, start, 2), lake.silver)
        refresh_gold(spark, lake, z)
        refresh_agg(spark, lake)
    before = sorted(map(tuple, lake.silver.as_of().collect()), key=repr)
    assert lake.silver.compact() is not None
    assert lake.gold.compact() is not None
    assert sorted(map(tuple, lake.silver.as_of().collect()), key=repr) == before
    lake.silver.as_of().explain("formatted")
    location = [line for line in capsys.readouterr().out.splitlines() if "Location:" in line][0]
    assert location.count("commit_id=") == 1  # one folder listed after compaction
    assert lake.silver.high_water_mark() == at(201)
    assert refresh_gold(spark, lake, z).mode == "skipped"
    assert refresh_agg(spark, lake).mode == "skipped"
    assert resolve_read_plan(lake.silver.commits_frame()).mode == FULL  # original rule: replace → full
    refresh_silver(spark, batch(spark, 300, 2), lake.silver)
    assert refresh_gold(spark, lake, z).mode == "incremental"
    assert refresh_agg(spark, lake).mode == "incremental"
    assert sum(r.total_trips for r in lake.agg.as_of().collect()) == 8


def test_bronze_file_with_zoned_timestamps(spark, tmp_root):
    root = f"{tmp_root}/raw"
    zoned = batch(spark, 0, 2).withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp"))
    zoned.coalesce(1).write.parquet(f"{root}/year=2024")
    batch(spark, 10, 1).coalesce(1).write.parquet(f"{root}/year=2025")
    rows = read_bronze(spark, raw_glob(root)).collect()
    assert sorted(r.tpep_pickup_datetime for r in rows) == [at(0), at(1), at(10)]
