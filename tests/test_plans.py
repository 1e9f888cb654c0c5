"""The physical plans the scale design depends on (checked with explain())."""

import re

from conftest import SMALL_SF
from helpers import trips_df
from tripmart import catalog
from tripmart.operators.merge import upsert
from tripmart.plans.versioned import VersionedTable
from tripmart.schemas import GOLD_PARTITIONS


def plan_of(df, capsys, mode="formatted"):
    df.explain(mode)
    return capsys.readouterr().out


def test_flagship_is_one_shuffle_after_a_partial_aggregate(spark, capsys):
    plan = plan_of(catalog.q_monthly_borough_agg(spark, SMALL_SF), capsys, "simple")
    assert plan.count("Exchange hashpartitioning") == 1
    partial = plan.index("partial_count")
    assert plan.index("Exchange hashpartitioning") < partial  # printed top-down: exchange sits above
    assert "SortMergeJoin" not in plan  # small sides broadcast


def test_watermark_reaches_the_orders_scan(spark, capsys):
    plan = plan_of(catalog.q_bronze_incremental(spark, SMALL_SF), capsys)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_orderdate", plan)


def test_merge_shuffles_each_side_once_and_prunes_the_target(spark, tmp_root, capsys):
    from tripmart.schemas import GOLD
    from tripmart.operators.enrich import to_gold

    zones = spark.createDataFrame([(100, "M", "Z", "Y")], "LocationID int, Borough string, Zone string, service_zone string")
    gold = VersionedTable(spark, tmp_root, GOLD, partition_by=GOLD_PARTITIONS)
    gold.append(to_gold(trips_df(spark, [{}]), zones))
    source = to_gold(trips_df(spark, [{"VendorID": 2}]), zones)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert(gold.as_of(), source, ["trip_id"], preserve=["created_at"], scope_cols=GOLD_PARTITIONS)
        plan = plan_of(merged.merged, capsys)
        simple = plan_of(merged.merged, capsys, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "FullOuter" in plan
    assert simple.count("Exchange hashpartitioning") == 2  # one per side; zones still broadcast
    assert simple.count("BroadcastExchange") == 2
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_year", plan)


def test_version_reads_list_only_live_commit_folders(spark, tmp_root, capsys):
    t = VersionedTable(spark, tmp_root, trips_df(spark, []).schema)
    t.append(trips_df(spark, [{}]))
    t.overwrite(trips_df(spark, [{"VendorID": 2}]))
    plan = plan_of(t.as_of(), capsys)
    location = re.search(r"Location: InMemoryFileIndex[^\n]*", plan).group(0)
    assert "commit_id=2" in location and "commit_id=1" not in location


def test_trips_view_does_not_shuffle_line_items_when_dimensions_are_small(spark, capsys):
    from tripmart.sources import tables

    plan = plan_of(tables.trips(spark, SMALL_SF), capsys, "simple")
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
