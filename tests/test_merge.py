"""MERGE upsert semantics, null-safe keys, duplicates, scope and idempotence."""

import pytest
from pyspark.sql import functions as F

from tripmart.operators.aggregate import merge_partial_aggs, monthly_borough_agg
from tripmart.operators.merge import upsert

SCHEMA = "k string, part int, v int, created string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([("a", 1, 1, "t"), ("b", 1, 2, "t"), ("c", 2, 3, "t")], SCHEMA)
    source = spark.createDataFrame([("b", 1, 20, "s"), ("d", 1, 40, "s")], SCHEMA)
    merged = upsert(target, source, ["k"], preserve=["created"]).merged
    assert rows(merged) == [("a", 1, 1, "t"), ("b", 1, 20, "t"), ("c", 2, 3, "t"), ("d", 1, 40, "s")]


def test_scope_reads_only_touched_partitions(spark):
    target = spark.createDataFrame([("a", 1, 1, "t"), ("c", 2, 3, "t")], SCHEMA)
    source = spark.createDataFrame([("a", 1, 10, "s")], SCHEMA)
    result = upsert(target, source, ["k"], preserve=["created"], scope_cols=["part"])
    assert result.scope == [{"part": 1}]
    assert rows(result.merged) == [("a", 1, 10, "t")]
    assert rows(result.full_table(target)) == [("a", 1, 10, "t"), ("c", 2, 3, "t")]


def test_null_safe_keys_match_null_groups(spark):
    schema = "y int, b string, n long"
    target = spark.createDataFrame([(2024, None, 1), (2024, "Q", 2)], schema)
    source = spark.createDataFrame([(2024, None, 5)], schema)
    merged = {r.b: r.n for r in upsert(target, source, ["y", "b"], null_safe=True).merged.collect()}
    assert merged == {None: 5, "Q": 2}
    plain = upsert(target, source, ["y", "b"], null_safe=False).merged
    assert plain.count() == 3  # '=' never matches NULL: the group is duplicated


def test_duplicate_source_keys(spark):
    target = spark.createDataFrame([("a", 1, 1, "t")], SCHEMA)
    source = spark.createDataFrame([("a", 1, 5, "s"), ("a", 1, 7, "s")], SCHEMA)
    with pytest.raises(Exception, match="duplicate"):
        upsert(target, source, ["k"]).merged.collect()
    deduped = upsert(target, source, ["k"], on_duplicate="dedupe", latest_by=["v"]).merged
    assert rows(deduped) == [("a", 1, 7, "s")]


def test_merge_twice_equals_merge_once(spark):
    target = spark.createDataFrame([("a", 1, 1, "t"), ("b", 2, 2, "t")], SCHEMA)
    source = spark.createDataFrame([("b", 2, 9, "s"), ("z", 3, 9, "s")], SCHEMA)
    once = upsert(target, source, ["k"], preserve=["created"]).merged
    twice = upsert(once, source, ["k"], preserve=["created"]).merged
    assert rows(once) == rows(twice)


def test_partial_aggregates_merge_to_the_full_aggregate(spark):
    gold = spark.createDataFrame(
        [
            ("t1", 2024, 1, "A", "B", 10.25, 1.5, 1),
            ("t2", 2024, 1, "A", "B", 0.1, 0.2, 2),
            ("t3", 2024, 1, None, "B", 3.0, 1.0, None),
            ("t4", 2024, 2, "A", None, 7.7, 2.2, 3),
        ],
        "trip_id string, pickup_year int, pickup_month int, pickup_borough string, "
        "dropoff_borough string, total_amount double, trip_distance double, passenger_count int",
    )
    full = monthly_borough_agg(gold)
    parts = merge_partial_aggs(
        monthly_borough_agg(gold.filter(F.col("trip_id") <= "t2")),
        monthly_borough_agg(gold.filter(F.col("trip_id") > "t2")),
    )
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(full.collect(), key=key) == sorted(parts.collect(), key=key)
    first = full.filter((F.col("pickup_month") == 1) & (F.col("pickup_borough") == "A")).first()
    assert first.total_trips == 2 and first.total_revenue == 10.35 and first.total_passengers == 3


def test_duplicate_key_across_partitions_is_caught(spark):
    target = spark.createDataFrame([("a", 1, 1, "t")], SCHEMA)
    source = spark.createDataFrame([("a", 1, 5, "s"), ("a", 2, 7, "s")], SCHEMA)
    with pytest.raises(Exception, match="duplicate"):
        upsert(target, source, ["k"], scope_cols=["part"]).merged.collect()


def test_hot_key_is_collapsed_before_the_shuffle(spark, capsys):
    # A third of the source on one key: the check fails at its second row, dedupe aggregates it map-side.
    rows = [("hot", 1, i, "s") for i in range(30)] + [(f"k{i}", 1, i, "s") for i in range(60)]
    source = spark.createDataFrame(rows, SCHEMA)
    target = spark.createDataFrame([("hot", 1, 0, "t")], SCHEMA)
    with pytest.raises(Exception, match="duplicate"):
        upsert(target, source, ["k"], scope_cols=["part"]).merged.collect()
    merged = upsert(target, source, ["k"], on_duplicate="dedupe", latest_by=["v"]).merged
    assert {r.k: r.v for r in merged.collect()}["hot"] == 29
    merged.explain()
    plan = capsys.readouterr().out
    assert "partial_max_by" in plan  # dedupe is a partial aggregate, not a window


def test_null_borough_groups_upserted_twice_stay_single(spark):
    schema = "pickup_year int, pickup_month int, pickup_borough string, dropoff_borough string, total_trips long"
    keys = ["pickup_year", "pickup_month", "pickup_borough", "dropoff_borough"]
    target = spark.createDataFrame([(2024, 1, None, "Q", 1), (2024, 1, "M", None, 2)], schema)
    source = spark.createDataFrame([(2024, 1, None, "Q", 5), (2024, 1, None, None, 7)], schema)
    once = upsert(target, source, keys, null_safe=True).merged
    twice = upsert(once, source, keys, null_safe=True).merged
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(
        [(2024, 1, None, "Q", 5), (2024, 1, "M", None, 2), (2024, 1, None, None, 7)], key=repr
    )


def test_unmatched_duplicates_are_inserted_and_matched_ones_fail(spark):
    target = spark.createDataFrame([("a", 1, 1, "t")], SCHEMA)
    source = spark.createDataFrame([("z", 1, 5, "s"), ("z", 1, 7, "s"), ("a", 1, 3, "s")], SCHEMA)
    assert rows(upsert(target, source, ["k"], on_duplicate="insert").merged) == [("a", 1, 3, "s"), ("z", 1, 5, "s"), ("z", 1, 7, "s")]
    with pytest.raises(Exception, match="duplicate"):
        upsert(target, source.union(source.where("k = 'a'")), ["k"], on_duplicate="insert").merged.collect()
    with pytest.raises(ValueError, match="unknown"):
        upsert(target, source, ["k"], on_duplicate="guess")


def test_duplicates_are_found_in_the_exchange_of_the_join(spark, capsys):
    target = spark.range(0, 1000).selectExpr("cast(id as string) k", "1 part", "1 v", "'t' created")
    source = spark.range(500, 1500).selectExpr("cast(id as string) k", "1 part", "2 v", "'s' created")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert(target, source, ["k"], scope_cols=["part"]).merged
        merged.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 2 and "InMemoryTableScan" not in plan and "Window" in plan
    assert merged.count() == 1500


def test_changes_are_the_replaced_and_written_rows(spark):
    target = spark.createDataFrame([("a", 1, 1, "t"), ("b", 1, 2, "t")], SCHEMA)
    source = spark.createDataFrame([("b", 1, 9, "s"), ("c", 2, 3, "s")], SCHEMA)
    result = upsert(target, source, ["k"], preserve=["created"])
    assert rows(result.changes) == [(-1, "b", 1, 2, "t"), (1, "b", 1, 9, "t"), (1, "c", 2, 3, "s")]
    mirrored = upsert(target, source, ["k"], delete_missing=True)
    assert rows(mirrored.changes) == [(-1, "a", 1, 1, "t"), (-1, "b", 1, 2, "t"), (1, "b", 1, 9, "s"), (1, "c", 2, 3, "s")]
