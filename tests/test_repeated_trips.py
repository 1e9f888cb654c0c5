"""Queries against their SQL where several trips share a trip_id, as they do on large tables."""

import os

import duckdb
import pytest
from conftest import SMALL_SF
from oracle_harness import compare

from tripmart.operators.aggregate import add_states, agg_delta, agg_state, monthly_borough_agg, state_to_agg
from tripmart.operators.merge import upsert

COPIES = 3


@pytest.fixture(scope="module")
def repeated(tmp_path_factory):
    """The smallest tables with every order there thrice: other order keys, equal trips."""
    root = tmp_path_factory.mktemp("repeated")
    for name in os.listdir(SMALL_SF):
        if name not in ("orders.parquet", "lineitem.parquet"):
            os.symlink(f"{SMALL_SF}/{name}", root / name)
    con = duckdb.connect()
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        con.execute(
            f"COPY (SELECT t.* REPLACE ({key} + 1000000 * i.range AS {key}) FROM '{SMALL_SF}/{name}.parquet' t, range({COPIES}) i) "
            f"TO '{root / name}.parquet' (FORMAT parquet)"
        )
    return str(root)


def assert_equal_to_sql(spark, sf_dir, key):
    rec = compare(spark, sf_dir, [key], verbose=False)[key]
    assert "error" not in rec, rec
    assert rec["rows"] > 0 and rec["cols_match"] and rec["rows_match"] and rec["hash_match"], rec


def test_agg_signed_deltas(spark, repeated):
    assert_equal_to_sql(spark, repeated, "agg_signed_deltas")


def test_merge_upsert_trips(spark, repeated):
    assert_equal_to_sql(spark, repeated, "merge_upsert_trips")


def test_named_table_select(spark, repeated):
    assert_equal_to_sql(spark, repeated, "named_table_select")


def test_pipeline_end_to_end(spark, repeated):
    assert_equal_to_sql(spark, repeated, "pipeline_end_to_end")


# -- the MERGE where all source rows of a key replace its target rows ---------
SCHEMA = "k string, part int, v int, created string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def replacing(target, source, **options):
    return upsert(target, source, ["k"], preserve=["created"], on_duplicate="replace", **options)


def test_all_rows_of_a_key_replace_all_others(spark):
    target = spark.createDataFrame([("a", 1, 1, "t2"), ("a", 1, 2, "t1"), ("b", 1, 3, "t"), (None, 1, 4, "t")], SCHEMA)
    source = spark.createDataFrame(
        [("a", 1, 5, "s"), ("a", 1, 6, "s"), ("a", 1, 6, "s"), ("c", 1, 7, "s"), ("c", 1, 8, "s"), (None, 1, 9, "s")], SCHEMA
    )
    written = [("a", 1, 5, "t1"), ("a", 1, 6, "t1"), ("a", 1, 6, "t1"), ("c", 1, 7, "s"), ("c", 1, 8, "s"), (None, 1, 9, "s")]
    kept = [("b", 1, 3, "t"), (None, 1, 4, "t")]
    result = replacing(target, source, scope_cols=["part"])
    assert result.scope == [{"part": 1}] and result.merged.dtypes == target.dtypes
    assert rows(result.merged) == sorted(written + kept, key=repr)
    signed = [(-1, "a", 1, 1, "t2"), (-1, "a", 1, 2, "t1")] + [(1, *r) for r in written]
    assert rows(result.changes) == sorted(signed, key=repr)
    mirrored = replacing(target, source, delete_missing=True)
    assert rows(mirrored.merged) == sorted(written, key=repr)
    assert rows(mirrored.changes) == sorted(signed + [(-1, *r) for r in kept], key=repr)
    null_safe = replacing(target, source, null_safe=True)
    assert rows(null_safe.merged) == sorted([r for r in written if r[0]] + [(None, 1, 9, "t"), kept[0]], key=repr)


def test_replacing_equals_the_join_where_keys_are_unique(spark):
    target = spark.createDataFrame([(f"k{i}", i % 3, i, "t" if i % 4 else None) for i in range(0, 30)], SCHEMA)
    source = spark.createDataFrame([(f"k{i}", i % 3, -i, "s") for i in range(20, 50)], SCHEMA)
    joined = upsert(target, source, ["k"], preserve=["created"])
    replaced = replacing(target, source)
    assert rows(replaced.merged) == rows(joined.merged)
    assert rows(replaced.changes) == rows(joined.changes)


def test_signed_deltas_of_repeated_keys_equal_recomputation(spark):
    schema = ("trip_id string, pickup_year int, pickup_month int, pickup_borough string, dropoff_borough string, "
              "total_amount double, trip_distance double, passenger_count int")  # fmt: skip
    target = spark.createDataFrame([(f"k{i % 20}", 2024, 1, "AB"[i % 2], "A", i / 4, 1.5, i) for i in range(60)], schema)
    source = spark.createDataFrame([(f"k{i % 9 + 15}", 2024, 1, "BC"[i % 2], None, i / 2, 2.5, None) for i in range(40)], schema)
    result = upsert(target, source, ["trip_id"], on_duplicate="replace")
    kept_up = state_to_agg(add_states(agg_state(target), agg_delta(result.changes)))
    assert result.merged.count() == 45 + 40
    assert rows(kept_up) == rows(monthly_borough_agg(result.merged))


def test_a_much_repeated_key_makes_no_pairs(spark, capsys):
    hot = spark.range(30_000).selectExpr("'hot' k", "1 part", "cast(id as int) v", "'x' created")
    result = replacing(hot, hot)
    assert result.changes.count() == 60_000 and result.merged.count() == 30_000
    result.changes.explain()
    assert "Join" not in capsys.readouterr().out


def test_pairs_of_repeated_keys(spark):
    target = spark.createDataFrame([("a", 1, 1, "t1"), ("a", 1, 2, "t2"), ("b", 1, 3, "t")], SCHEMA)
    source = spark.createDataFrame([("a", 1, 5, "s"), ("a", 1, 6, "s"), ("c", 1, 7, "s"), ("c", 1, 7, "s")], SCHEMA)
    pairs = [("a", 1, v, t) for v in (5, 6) for t in ("t1", "t2")] + [("c", 1, 7, "s")] * 2
    result = upsert(target, source, ["k"], preserve=["created"], on_duplicate="pairs")
    assert rows(result.merged) == sorted([*pairs, ("b", 1, 3, "t")], key=repr)
    signed = [(-1, "a", 1, 1, "t1"), (-1, "a", 1, 2, "t2")] + [(1, *r) for r in pairs]
    assert rows(result.changes) == sorted(signed, key=repr)
    mirrored = upsert(target, source, ["k"], preserve=["created"], on_duplicate="pairs", delete_missing=True)
    assert rows(mirrored.merged) == sorted(pairs, key=repr)
    assert rows(mirrored.changes) == sorted([*signed, (-1, "b", 1, 3, "t")], key=repr)
