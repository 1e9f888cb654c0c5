"""Late rows, self-maintaining aggregate, physical order, rejecting casts, landing outcomes, named tables, file ledger."""

import datetime as dt
import os
import random

import pytest
from helpers import T0, trips_df
from pyspark.sql import functions as F

from tripmart.operators.aggregate import add_states, agg_delta, agg_state, monthly_borough_agg, state_to_agg
from tripmart.operators.casts import reject_counts, split_casts
from tripmart.operators.merge import upsert
from tripmart.plans.incremental import late_rows
from tripmart.plans.named_tables import publish, publish_lake
from tripmart.plans.pipeline import Lakehouse, refresh_silver, run_pipeline
from tripmart.plans.sql_surface import create_table
from tripmart.schemas import GOLD_PARTITIONS, ZONES
from tripmart.sources.bronze import file_listing, raw_glob, read_bronze, read_new_files, widest_type
from tripmart.sources.landing import landing_outcomes, landing_records, month_plan, outcome_report
from tripmart.sources.sortedness import order_violations

DAY = dt.timedelta(days=1)


def zones(spark):
    return spark.createDataFrame([(100, "M", "Z1", "Y"), (200, "Q", "Z2", "Y"), (300, "B", "Z3", "Y")], ZONES)


def at(days, **more):
    return {"tpep_pickup_datetime": T0 + days * DAY, "tpep_dropoff_datetime": T0 + days * DAY + dt.timedelta(minutes=9), **more}


# -- late rows ---------------------------------------------------------------
def test_late_rows_load_once_and_only_inside_the_window(spark, tmp_root):
    lake = Lakehouse.at(spark, tmp_root)
    refresh_silver(spark, trips_df(spark, [at(0), at(10)]), lake.silver)
    everything = trips_df(spark, [at(0), at(10), at(9), at(9), at(3), at(12), at(5, VendorID=2)])
    for _ in range(3):
        refresh_silver(spark, everything, lake.silver, lookback_days=6)
    days = sorted((r.tpep_pickup_datetime - T0).days for r in lake.silver.as_of().collect())
    assert days == [0, 5, 9, 9, 10, 12]  # day 3 lies before the window; equal new rows come in together
    plain = Lakehouse.at(spark, f"{tmp_root}/plain")
    refresh_silver(spark, trips_df(spark, [at(0), at(10)]), plain.silver)
    refresh_silver(spark, everything, plain.silver)
    assert plain.silver.as_of().count() == 3


def test_late_rows_read_a_window_of_both_sides(spark, tmp_root, capsys):
    trips_df(spark, [at(0), at(9)]).write.parquet(f"{tmp_root}/b")
    trips_df(spark, [at(0)]).write.parquet(f"{tmp_root}/s")
    read = spark.read.schema(trips_df(spark, []).schema).parquet
    late_rows(read(f"{tmp_root}/b"), read(f"{tmp_root}/s"), "tpep_pickup_datetime", T0 + 9 * DAY, 3).explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("GreaterThan(tpep_pickup_datetime") == 2 and plan.count("LessThanOrEqual(tpep_pickup_datetime") == 2


# -- self-maintaining aggregate ----------------------------------------------
GOLD_LIKE = ("trip_id string, pickup_year int, pickup_month int, pickup_borough string, dropoff_borough string, "
             "total_amount double, trip_distance double, passenger_count int")  # fmt: skip


def random_gold(rng, keys):
    money = lambda: rng.choice([None, 0.1, 0.2, 19.99, round(rng.uniform(-500, 1e6), 2)])
    return [(k, 2024, int(k[1:]) % 3, rng.choice([None, "A", "B"]), rng.choice([None, "A"]), money(), money(), rng.choice([None, 1, 4]))
            for k in keys]


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_signed_deltas_equal_recomputation(spark, seed):
    rng = random.Random(seed)
    gold = spark.createDataFrame(random_gold(rng, [f"k{i}" for i in range(40)]), GOLD_LIKE)
    state = agg_state(gold)
    for step in range(3):
        keys = [f"k{i}" for i in rng.sample(range(60), rng.choice([1, 20, 45]))]
        source = spark.createDataFrame(random_gold(rng, keys), GOLD_LIKE)
        result = upsert(gold, source, ["trip_id"], delete_missing=step == 2)
        state = add_states(state, agg_delta(result.changes))
        gold = spark.createDataFrame(result.merged.collect(), GOLD_LIKE)
        state = spark.createDataFrame(state.collect(), state.schema)
        assert as_set(state_to_agg(state)) == as_set(monthly_borough_agg(gold))
        assert state_to_agg(state).columns == monthly_borough_agg(gold).columns


def test_emptied_groups_go_and_lost_values_become_null(spark):
    rows = [("k1", 2024, 1, "A", "A", 5.0, 1.0, 2), ("k2", 2024, 1, "B", "A", 7.0, None, None), ("k3", 2024, 1, "B", "A", 7.5, 2.0, 1)]
    gold = spark.createDataFrame(rows, GOLD_LIKE)
    source = spark.createDataFrame([("k1", 2024, 1, "B", "A", 1.0, 1.0, 1), ("k3", 2024, 1, "C", None, 7.5, 2.0, None)], GOLD_LIKE)
    changes = upsert(gold, source, ["trip_id"]).changes
    got = as_set(state_to_agg(add_states(agg_state(gold), agg_delta(changes))))
    assert got == [(2024, 1, "B", "A", 2, 8.0, 1.0, 1), (2024, 1, "C", None, 1, 7.5, 2.0, None)]
    with pytest.raises(Exception, match="fixed-point"):
        agg_state(spark.createDataFrame([("k", 2024, 1, "A", "A", float("nan"), 1.0, 1)], GOLD_LIKE)).collect()


def test_aggregate_ships_two_words_a_sum(spark, capsys):
    monthly_borough_agg(spark.createDataFrame([], GOLD_LIKE)).explain()
    assert "decimal" not in capsys.readouterr().out.split("Exchange")[1].lower()  # no decimal buffer below the shuffle


# -- physical order ----------------------------------------------------------
def test_order_violations(spark, tmp_root):
    df = spark.createDataFrame([(1,), (2,), (2,), (5,)], "v int").coalesce(1)
    df.write.parquet(f"{tmp_root}/sorted")
    assert tuple(order_violations(spark.read.parquet(f"{tmp_root}/sorted"), "v").first()) == (4, 0)
    spark.createDataFrame([(3,), (1,), (2,), (None,), (0,)], "v int").coalesce(1).write.parquet(f"{tmp_root}/unsorted")
    assert tuple(order_violations(spark.read.parquet(f"{tmp_root}/unsorted"), "v").first()) == (5, 2)
    both = spark.read.parquet(f"{tmp_root}/sorted", f"{tmp_root}/unsorted")
    assert tuple(order_violations(both, "v").first()) == (9, 2)
    assert tuple(order_violations(both.where("v > 100"), "v").first()) == (0, 0)


# -- casts -------------------------------------------------------------------
def test_split_casts(spark):
    rows = [("1", 5, 1.5), ("x", 5, 2.5), (None, 3_000_000_000, 1e300), ("7", None, None), ("y", 3_000_000_000, 0.1)]
    df = spark.createDataFrame(rows, "a string, b bigint, c double")
    accepted, rejected = split_casts(df, {"a": "int", "b": "int", "c": "float"})
    assert accepted.dtypes == [("a", "int"), ("b", "int"), ("c", "float")]
    assert sorted(map(tuple, accepted.collect())) == [(1, 5, 1.5), (7, None, None)]
    assert sorted((r.a or "", r.rejected_columns) for r in rejected.collect()) == [("", ["b"]), ("x", ["a"]), ("y", ["a", "b"])]
    assert sorted(map(tuple, reject_counts(rejected).collect())) == [("a", 1), ("a,b", 1), ("b", 1)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST_OVERFLOW"):
        df.select(F.col("a").cast("int")).collect()


# -- landing -----------------------------------------------------------------
def test_landing_outcomes(spark):
    months = "data_year int, data_month int"
    frame = lambda *m: spark.createDataFrame(list(m), months)
    plan = month_plan(frame(*[(2024, m) for m in range(1, 8)]), dt.date(2024, 7, 3))
    before = frame((2024, 1), (2024, 2), (2023, 12))
    after = frame((2024, 1), (2024, 3), (2024, 3), (2023, 12), (2024, 6))
    errors = spark.createDataFrame([(2024, 4, "HTTP 404"), (2024, 4, "HTTP 500"), (2024, 6, "timeout")], months + ", error string")
    out = landing_outcomes(plan, before, after, errors, "https://host/")
    got = {(r.data_year, r.data_month): (r.status, r.error) for r in out.collect()}
    assert got == {(2023, 12): ("unplanned", None), (2024, 1): ("skipped", None), (2024, 2): ("lost", None), (2024, 3): ("success", None),
                   (2024, 4): ("failed", "HTTP 500"), (2024, 5): ("missing", None), (2024, 6): ("success", "timeout"),
                   (2024, 7): ("pending", None)}
    report = {r.status: (r.months, r.run_status) for r in outcome_report(out).collect()}
    assert report["success"] == (2, "failed") and len(report) == 7
    records = {r.month: r for r in landing_records(out).collect() if r.year == 2024}
    assert records[4].error == "HTTP 500" and records[4].reason == "Download failed"
    assert records[3].source_url == "https://host/yellow_tripdata_2024-03.parquet"
    fine = landing_outcomes(plan.where("data_month = 1"), before.limit(0), frame((2024, 1)), errors.limit(0))
    assert [tuple(r) for r in outcome_report(fine).collect()] == [("success", 1, "completed")]


# -- named tables ------------------------------------------------------------
def test_select_by_name_in_a_new_session(spark, tmp_root):
    lake, z = Lakehouse.at(spark, f"{tmp_root}/lake"), zones(spark)
    run_pipeline(spark, trips_df(spark, [at(0), at(40)]), lake, z)
    assert publish_lake(spark, lake, "named_db", f"{tmp_root}/db") == {"gold": 2, "agg": 2}
    run_pipeline(spark, trips_df(spark, [at(0), at(40), at(41), at(80)]), lake, z)
    changed = publish_lake(spark, lake, "named_db", f"{tmp_root}/db")
    assert changed["agg"] == 2  # one month grew, one is new; the first is left alone
    assert publish_lake(spark, lake, "named_db", f"{tmp_root}/db") == {"gold": 0, "agg": 0}
    other = spark.newSession()
    for name, table in (("gold", lake.gold), ("agg", lake.agg)):
        columns = table.schema.fieldNames()
        got = other.table(f"named_db.{name}").select(*columns)
        assert as_set(got) == as_set(table.as_of().select(*columns))
    assert other.sql("SELECT SUM(total_trips) FROM named_db.agg WHERE pickup_month = 2").first()[0] == 2
    lake.gold.delete_where(F.col("pickup_month") == 1)
    publish(spark, "`named_db`.`gold`", lake.gold)
    assert other.sql("SELECT DISTINCT pickup_month FROM named_db.gold").count() == 2
    spark.sql("DROP DATABASE named_db CASCADE")
    assert lake.agg.as_of().count() == 3  # external tables: dropping them leaves the folders


def test_appended_tables_cannot_be_published(spark, tmp_root):
    lake = Lakehouse.at(spark, f"{tmp_root}/lake")
    for _ in range(2):
        lake.gold.append(lake.gold.as_of().limit(0).union(_gold_row(spark)))
    create_table(spark, "default.appended", lake.gold.schema, GOLD_PARTITIONS, location=lake.gold.data_root)
    with pytest.raises(ValueError, match="lies in commits"):
        publish(spark, "default.appended", lake.gold)
    spark.sql("DROP TABLE default.appended")


def _gold_row(spark):
    from tripmart.operators.enrich import to_gold

    return to_gold(trips_df(spark, [{}]), zones(spark))


# -- raw files ---------------------------------------------------------------
def test_widest_types():
    names = [str(widest_type(set(t))) for t in (["int32", "int64"], ["int32", "double"], ["float", "double"], ["string"], ["timestamp[us]"])]
    assert names == ["LongType()", "DoubleType()", "DoubleType()", "StringType()", "TimestampNTZType()"]
    assert widest_type({"int64", "string"}) is None and widest_type({"int64", "double"}) is None


def test_drifted_files_are_one_scan(spark, tmp_root, capsys):
    trips = trips_df(spark, [at(0)])
    trips.drop("Airport_fee").withColumn("extra", F.col("extra").cast("float")).write.parquet(f"{tmp_root}/raw/year=2023")
    trips.withColumn("PULocationID", F.col("PULocationID").cast("bigint")).write.parquet(f"{tmp_root}/raw/year=2024")
    df = read_bronze(spark, raw_glob(f"{tmp_root}/raw"))
    df.explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan
    assert df.schema == read_bronze(spark, raw_glob(f"{tmp_root}/raw/../raw")).schema
    assert sorted(str(r.Airport_fee) for r in df.collect()) == ["0.0", "None"] and {r.PULocationID for r in df.collect()} == {100}
    trips.withColumn("VendorID", F.lit("2")).write.parquet(f"{tmp_root}/raw/year=2025")
    assert sorted(r.VendorID for r in read_bronze(spark, raw_glob(f"{tmp_root}/raw")).collect()) == [1, 1, 2]


def test_an_increment_opens_unseen_files_only(spark, tmp_root):
    raw, ledger = f"{tmp_root}/raw", f"{tmp_root}/ledger"
    for year in (2021, 2022, 2023):
        trips_df(spark, [at(0, VendorID=1)]).coalesce(1).write.parquet(f"{raw}/year={year}")
    first = read_new_files(spark, raw_glob(raw), ledger)
    assert first.rows.count() == 3 and first.files.count() == 3
    again = read_new_files(spark, raw_glob(raw), ledger)  # not committed yet: nothing is lost
    assert again.rows.count() == 3
    first.commit()
    assert read_new_files(spark, raw_glob(raw), ledger) is None
    # What was read is spoilt, with length and time kept: opening it would fail.
    for f in file_listing(spark, raw_glob(raw)).collect():
        path = f.file.removeprefix("file:")
        path = "/" + path.lstrip("/")
        stat = os.stat(path)
        with open(path, "wb") as spoilt:
            spoilt.write(b"x" * stat.st_size)
        os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    trips_df(spark, [at(1, VendorID=2)]).coalesce(1).write.parquet(f"{raw}/year=2024")
    new = read_new_files(spark, raw_glob(raw), ledger)
    assert new.footers.select("file").distinct().count() == 1
    assert [r.VendorID for r in new.rows.collect()] == [2]
    new.commit()
    assert read_new_files(spark, raw_glob(raw), ledger) is None
