"""Registered queries: one Spark DataFrame builder per operator, plus its oracle.

Each builder takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` in full and returns a lazy DataFrame.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import oracle_sql as sql
from .functions.calendar import calendar_parts
from .functions.keys import TRIP_KEY_FIELDS, trip_id
from .functions.measures import stable_sum
from .functions.quality import PICKUP, clean_predicate
from .operators.aggregate import (
    add_states,
    agg_delta,
    agg_state,
    high_water_mark,
    merge_partial_aggs,
    monthly_borough_agg,
    state_to_agg,
    with_avg_revenue,
)
from .operators.casts import reject_counts, split_casts
from .operators.clean import apply_global_rules, apply_rate_rules, clean_trips, reject_reasons
from .operators.enrich import enrich_with_zones, to_gold
from .operators.merge import upsert
from .plans.incremental import read_after_watermark, scalar
from .plans.named_tables import publish_lake
from .plans.pipeline import Lakehouse, refresh_agg, refresh_gold, refresh_silver, run_pipeline
from .plans.read_plan import read_plans
from .plans.versioned import COMMIT_COL, appended_predicate, commits_from_frame, latest_commits, live_predicate
from .schemas import AGG, AGG_KEYS, GOLD_PARTITIONS
from .session import scratch_path
from .sources import history, tables
from .sources.bronze import file_listing, raw_glob, read_bronze, read_new_files, schema_drift
from .sources.landing import (
    landing_outcomes,
    landing_report,
    landing_status,
    missing_months,
    month_plan,
    months_of_years,
    outcome_report,
    previous_month,
)
from .sources.sortedness import order_violations
from .sources.zones import read_zones_csv, write_zones_csv
from .streaming import ingest_available

Query = Callable[[SparkSession, str], DataFrame]

# Fixed created_at for checked gold rows: current_timestamp is never compared.
CHECKED_CREATED_AT = "2024-01-01 00:00:00"


def _created_at(value: str = CHECKED_CREATED_AT):
    return F.lit(value).cast("timestamp")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(tables.trips(spark, sf_dir), tables.FIXTURE_EXCLUDED_LOCATIONS)


def _gold(spark: SparkSession, sf_dir: str, created_at: str = CHECKED_CREATED_AT) -> DataFrame:
    return to_gold(_silver(spark, sf_dir), tables.zones(spark, sf_dir), created_at=_created_at(created_at))


def q_monthly_borough_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: clean → enrich → gold → monthly borough-pair aggregate."""
    return monthly_borough_agg(_gold(spark, sf_dir))


# Silver as of the first load: trips picked up before this instant.
FIRST_LOAD_BEFORE = "2000-01-01 00:00:00"


def _first_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).filter(F.col(PICKUP) < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))


def q_monthly_borough_agg_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same aggregate through SQL: gold as a temp view, GROUP BY ordinals."""
    view = f"gold_incoming_{uuid.uuid4().hex[:8]}"
    _gold(spark, sf_dir).createOrReplaceTempView(view)
    try:
        return spark.sql(
            f"""
            SELECT pickup_year, pickup_month, pickup_borough, dropoff_borough,
                   COUNT(trip_id) AS total_trips,
                   CAST(SUM(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
                   CAST(SUM(CAST(trip_distance AS DECIMAL(18, 2))) AS DOUBLE) AS total_trip_distance,
                   CAST(SUM(passenger_count) AS BIGINT) AS total_passengers
            FROM {view}
            GROUP BY 1, 2, 3, 4
            """
        )
    finally:
        spark.catalog.dropTempView(view)  # the analysed query no longer needs it


def q_dq_global_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules F1–F10 over the raw trips."""
    return apply_global_rules(tables.trips(spark, sf_dir), tables.FIXTURE_EXCLUDED_LOCATIONS)


def q_dq_rate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules F11–F17 over the raw trips."""
    return apply_rate_rules(tables.trips(spark, sf_dir))


def q_dq_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected trips counted by the first rule they fail."""
    return reject_reasons(tables.trips(spark, sf_dir), tables.FIXTURE_EXCLUDED_LOCATIONS)


def q_dq_reject_reasons_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over trips with faults that the given tables lack: every one of the 16 rules is the first to fail."""
    return reject_reasons(tables.faulty_trips(spark, sf_dir), tables.FIXTURE_EXCLUDED_LOCATIONS)


def q_dq_clean_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that pass every rule, out of the faulty ones."""
    return clean_trips(tables.faulty_trips(spark, sf_dir), tables.FIXTURE_EXCLUDED_LOCATIONS)


def q_gold_single_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold with distances and amounts cast to FLOAT, as the original job stored them."""
    zones = tables.zones(spark, sf_dir)
    return to_gold(_silver(spark, sf_dir), zones, created_at=_created_at(), single_precision=True)


# A feed in which some values do not fit their type: scaled counts, a word for the third payment type.
FEED_SCALE = 100_000_000
FEED_CASTS = {"passenger_count": "int", "payment_type": "int", "RatecodeID": "tinyint"}


def _raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = tables.trips(spark, sf_dir)
    payment = F.when(F.col("payment_type") == 3, F.lit("no charge")).otherwise(F.col("payment_type").cast("string"))
    return trips.withColumns({"passenger_count": F.col("passenger_count") * FEED_SCALE, "payment_type": payment})


def q_cast_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the feed whose counts, payment types and rate codes all cast."""
    return split_casts(_raw_feed(spark, sf_dir), FEED_CASTS)[0]


def q_cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the feed that a strict cast would have ended the job at, by the columns at fault."""
    return reject_counts(split_casts(_raw_feed(spark, sf_dir), FEED_CASTS)[1])


def q_zone_enrich_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both zone roles left-joined onto every raw trip."""
    return enrich_with_zones(tables.trips(spark, sf_dir), tables.zones(spark, sf_dir))


def q_trip_key_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trip_id (sha-256 of the key fields) for every raw trip."""
    return tables.trips(spark, sf_dir).select(trip_id().alias("trip_id"), *TRIP_KEY_FIELDS)


def q_calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date/year/month/day/weekday/hour of every event timestamp."""
    return tables.table(spark, sf_dir, "events").select("event_id", *calendar_parts("ts", "event"))


def q_gold_obt_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 24-column gold table (fixed created_at)."""
    return _gold(spark, sf_dir)


def q_silver_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and silver row counts from one pass over the trips."""
    return tables.trips(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(clean_predicate(tables.FIXTURE_EXCLUDED_LOCATIONS)).alias("silver_rows"),
    )


def q_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAX pickup time of the first-load silver."""
    return high_water_mark(_first_silver(spark, sf_dir), PICKUP)


def q_bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows strictly newer than the silver high-water mark."""
    watermark = scalar(high_water_mark(_first_silver(spark, sf_dir), PICKUP))
    return read_after_watermark(tables.trips(spark, sf_dir), PICKUP, watermark)


def q_top_borough_pairs(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Top-k borough pairs by trips (ties broken by borough names, NULLs first)."""
    pairs = _gold(spark, sf_dir).groupBy("pickup_borough", "dropoff_borough").agg(
        F.count("trip_id").alias("total_trips"),
        stable_sum("total_amount").alias("total_revenue"),
    )
    order = [
        F.col("total_trips").desc(),
        F.col("pickup_borough").asc_nulls_first(),
        F.col("dropoff_borough").asc_nulls_first(),
    ]
    # orderBy + limit plans a TakeOrderedAndProject: each task keeps its own
    # top k, only k rows per task reach the final merge.
    top = pairs.orderBy(*order).limit(k)
    return top.withColumn("pair_rank", F.row_number().over(Window.orderBy(*order)).cast("int"))


def q_demand_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips, revenue and average fare per pickup zone (derived average)."""
    zones = _gold(spark, sf_dir).groupBy("pickup_borough", "pickup_zone").agg(
        F.count("trip_id").alias("total_trips"),
        stable_sum("total_amount").alias("total_revenue"),
    )
    return with_avg_revenue(zones)


def q_demand_by_hour_dow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event counts and value by weekday and hour."""
    events = tables.table(spark, sf_dir, "events")
    return events.groupBy(
        F.date_format("ts", "EEEE").alias("day_of_week"),
        F.hour("ts").cast("int").alias("hour_of_day"),
    ).agg(F.count(F.lit(1)).alias("events"), stable_sum("value").alias("total_value"))


# Versions read by the snapshot queries.
AS_OF_COMMIT = 6
RANGE_START, RANGE_END = 2, 7


def q_latest_two_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest two commits of the order history (snapshot metadata scan)."""
    log = history.commit_log(history.committed_orders(spark, sf_dir))
    return latest_commits(log, 2)


def q_snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order history as of commit 6: the latest full overwrite (4) and later appends."""
    committed = history.committed_orders(spark, sf_dir)
    commits = commits_from_frame(history.commit_log(committed))
    return committed.filter(live_predicate(commits, AS_OF_COMMIT))


def q_snapshot_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended in commits (2, 7]; the overwrite commit is not an append."""
    committed = history.committed_orders(spark, sf_dir)
    commits = commits_from_frame(history.commit_log(committed))
    return committed.filter(appended_predicate(commits, RANGE_START, RANGE_END))


def q_read_plan_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full/delta decision a consumer gets after each commit of the history."""
    log = history.commit_log(history.committed_orders(spark, sf_dir))
    return read_plans(log.drop("rows"), log.select(COMMIT_COL, "rows"))


# Upsert scenario: the target was loaded from trips picked up before 2000; a
# redelivery of everything picked up from 1998 on is merged into it.
MERGE_TARGET_BEFORE = "2000-01-01 00:00:00"
MERGE_SOURCE_FROM = "1998-01-01 00:00:00"
MERGE_SOURCE_CREATED_AT = "2024-02-01 00:00:00"
AGG_SOURCE_FROM = "1999-01-01 00:00:00"


def _gold_window(spark, sf_dir, lower=None, upper=None, created_at=CHECKED_CREATED_AT) -> DataFrame:
    silver = _silver(spark, sf_dir)
    ts = F.col(PICKUP)
    if lower:
        silver = silver.filter(ts >= F.lit(lower).cast("timestamp_ntz"))
    if upper:
        silver = silver.filter(ts < F.lit(upper).cast("timestamp_ntz"))
    return to_gold(silver, tables.zones(spark, sf_dir), created_at=_created_at(created_at))


def q_merge_upsert_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MERGE on trip_id: source wins, created_at kept from the target, scoped to touched months.

    Of trips that share a trip_id, each source row comes once per target row, as in a LEFT JOIN.
    """
    target = _gold_window(spark, sf_dir, upper=MERGE_TARGET_BEFORE)
    source = _gold_window(spark, sf_dir, lower=MERGE_SOURCE_FROM, created_at=MERGE_SOURCE_CREATED_AT)
    result = upsert(
        target, source, ["trip_id"], preserve=["created_at"], scope_cols=GOLD_PARTITIONS, on_duplicate="pairs"
    )
    return result.full_table(target)


def q_merge_partial_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor 1's aggregate plus vendor 2's delta, union-by-name and re-summed."""
    gold = _gold(spark, sf_dir)
    existing = monthly_borough_agg(gold.filter(F.col("vendor_id") == 1))
    delta = monthly_borough_agg(gold.filter(F.col("vendor_id") != 1))
    return merge_partial_aggs(existing, delta)


def q_merge_monthly_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MERGE of a recomputed aggregate into a stale one on null-safe group keys."""
    target = monthly_borough_agg(_gold_window(spark, sf_dir, upper=MERGE_TARGET_BEFORE))
    source = monthly_borough_agg(_gold_window(spark, sf_dir, lower=AGG_SOURCE_FROM))
    return upsert(target, source, AGG_KEYS, null_safe=True).merged


def q_agg_signed_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate kept up to date by a MERGE's replaced (-1) and written (+1) rows.

    The redelivery raises every amount and names the boroughs in lower case, so
    its trips leave their old groups and enter new ones.  Trips that share a
    trip_id are all kept: those delivered replace those stored.
    """
    target = _gold_window(spark, sf_dir, upper=MERGE_TARGET_BEFORE)
    source = _gold_window(spark, sf_dir, lower=MERGE_SOURCE_FROM).withColumns(
        {
            "pickup_borough": F.lower("pickup_borough"),
            "total_amount": F.col("total_amount") + 10,
            "passenger_count": F.when(F.col("passenger_count") % 5 > 0, F.col("passenger_count")),
        }
    )
    result = upsert(
        target, source, ["trip_id"], preserve=["created_at"], scope_cols=GOLD_PARTITIONS, on_duplicate="replace"
    )
    return state_to_agg(add_states(agg_state(target), agg_delta(result.changes)))


LATE_VENDOR, LOOKBACK_DAYS = 2, 400


def q_late_rows_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after one vendor's trips arrive late, below the watermark that the other's set.

    The second run looks back 400 days; the third finds nothing new, so every
    trip is loaded once, and late trips older than the window stay out.
    """
    lake = Lakehouse.at(spark, scratch_path(spark, "late-rows"))
    trips = tables.trips(spark, sf_dir)
    early = (F.col(PICKUP) < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz")) & (F.col("VendorID") != LATE_VENDOR)
    for bronze in (trips.filter(early), trips, trips):
        refresh_silver(spark, bronze, lake.silver, tables.FIXTURE_EXCLUDED_LOCATIONS, lookback_days=LOOKBACK_DAYS)
    return lake.silver.as_of()


def q_silver_sort_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a written silver table and how many of them break the pickup order inside their file."""
    lake = Lakehouse.at(spark, scratch_path(spark, "silver-sorted"))
    lake.silver.overwrite(_silver(spark, sf_dir))
    return order_violations(spark.read.parquet(lake.silver.data_root), PICKUP)


def q_named_table_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly aggregate by table name from another session, after two runs published to the catalog.

    The MERGE is a plain one: new trips that share a trip_id are all inserted.
    """
    root = scratch_path(spark, "named")
    lake = Lakehouse.at(spark, root)
    trips, zones = tables.trips(spark, sf_dir), tables.zones(spark, sf_dir)
    first = trips.filter(F.col(PICKUP) < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    database = f"trips_{uuid.uuid4().hex[:8]}"
    for bronze in (first, trips):
        run_pipeline(
            spark, bronze, lake, zones, tables.FIXTURE_EXCLUDED_LOCATIONS, created_at=_created_at(), on_duplicate="insert"
        )
        publish_lake(spark, lake, database, f"{root}/catalog")
    columns = ", ".join(AGG.fieldNames())
    return spark.newSession().sql(f"SELECT {columns} FROM {database}.agg")


def q_bronze_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the files that landed after the first load, told by the ledger of files already read."""
    root, ledger = scratch_path(spark, "landing-files"), scratch_path(spark, "landing-ledger")
    trips = tables.trips(spark, sf_dir).withColumn("year", F.year(PICKUP))
    early = F.col("year") <= INT64_LOCATION_YEAR
    trips.filter(early).write.partitionBy("year").parquet(root)
    read_new_files(spark, raw_glob(root), ledger).commit()
    wide = trips.filter(~early).withColumn("DOLocationID", F.col("DOLocationID").cast("bigint"))
    wide.write.mode("append").partitionBy("year").parquet(root)
    return read_new_files(spark, raw_glob(root), ledger).rows


def q_incremental_load_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows after a full load of pre-2000 trips, then an incremental load of all trips."""
    lake = Lakehouse.at(spark, scratch_path(spark, "incremental-load"))
    trips = tables.trips(spark, sf_dir)
    first = trips.filter(F.col(PICKUP) < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    full = refresh_silver(spark, first, lake.silver, tables.FIXTURE_EXCLUDED_LOCATIONS)
    refresh_silver(spark, trips, lake.silver, tables.FIXTURE_EXCLUDED_LOCATIONS)
    live = lake.silver.as_of(with_commit_id=True)
    return live.agg(
        F.count_if(F.col(COMMIT_COL) == full.commit_id).alias("rows_before"),
        F.count_if(F.col(COMMIT_COL) != full.commit_id).alias("rows_added"),
        F.count(F.lit(1)).alias("rows_after"),
    )


def q_pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scheduled runs of the whole chain (first landing, then everything):
    silver by watermark, gold by MERGE (new trips that share a trip_id are all
    inserted), aggregate by touched months.  The final aggregate must equal one
    computed over all clean trips at once."""
    lake = Lakehouse.at(spark, scratch_path(spark, "pipeline"))
    trips = tables.trips(spark, sf_dir)
    zones = tables.zones(spark, sf_dir)
    first = trips.filter(F.col(PICKUP) < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    for bronze in (first, trips):
        run_pipeline(
            spark, bronze, lake, zones, tables.FIXTURE_EXCLUDED_LOCATIONS, created_at=_created_at(), on_duplicate="insert"
        )
    return lake.agg.as_of()


def q_agg_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate job where no aggregate exists yet: computed in full from gold."""
    lake = Lakehouse.at(spark, scratch_path(spark, "agg-first-run"))
    lake.gold.overwrite(_gold(spark, sf_dir))
    refresh_agg(spark, lake)
    return lake.agg.as_of()


def q_gold_empty_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load job by the two-newest-commits rule when the newest append is empty: all of silver is read."""
    lake = Lakehouse.at(spark, scratch_path(spark, "empty-delta"))
    silver = _silver(spark, sf_dir)
    lake.silver.overwrite(silver)
    lake.silver.append(silver.filter(F.col(PICKUP).isNull()))  # no clean trip lacks its pickup time
    zones = tables.zones(spark, sf_dir)
    refresh_gold(spark, lake, zones, created_at=_created_at(), progress="latest-two", on_duplicate="insert")
    return lake.gold.as_of()


def q_silver_sorted_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trips written as a day-partitioned, pickup-sorted snappy table and read back.

    The fixture spreads few rows over ~2,500 pickup days, so this writes many
    tiny files; it exercises the day transform, not a tuned layout.
    """
    lake = Lakehouse.at(spark, scratch_path(spark, "silver-write"), silver_grain="day")
    lake.silver.overwrite(_silver(spark, sf_dir))
    return lake.silver.as_of()


def q_zone_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension round trip through a headed CSV file read with its schema."""
    path = scratch_path(spark, "zones-csv")
    write_zones_csv(tables.all_zones(spark, sf_dir), path)
    return read_zones_csv(spark, path)


# Drift in the landed files: 1995 files lack the CBD fee column, 1996 files
# store location ids as int64; later years match the bronze schema.
NO_CBD_FEE_YEAR, INT64_LOCATION_YEAR = 1995, 1996


def _land_drifted_trips(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "landing")
    trips = tables.trips(spark, sf_dir)
    year = F.year(PICKUP)
    trips.filter(year == NO_CBD_FEE_YEAR).drop("cbd_congestion_fee").write.parquet(
        f"{root}/year={NO_CBD_FEE_YEAR}"
    )
    trips.filter(year == INT64_LOCATION_YEAR).withColumns(
        {c: F.col(c).cast("bigint") for c in ("PULocationID", "DOLocationID")}
    ).write.parquet(f"{root}/year={INT64_LOCATION_YEAR}")
    trips.filter(year > INT64_LOCATION_YEAR).withColumn("year", year).write.mode("append").partitionBy(
        "year"
    ).parquet(root)
    return root


def q_bronze_drift_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze scan over files with a missing column and a widened type."""
    root = _land_drifted_trips(spark, sf_dir)
    return read_bronze(spark, raw_glob(root))


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-column drift report over the landed files: yearly folders that carry it, types and drift kind.

    How many files a folder has depends on the writing tasks, so files are left out.
    """
    root = _land_drifted_trips(spark, sf_dir)
    report = schema_drift(spark, file_listing(spark, raw_glob(root)))
    return report.select("column", "folders", F.array_join("types", ",").alias("types"), "expected_type", "drift")


def q_stream_ingest_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips landed as yearly files, ingested by the file stream in two runs."""
    raw, lake_root = scratch_path(spark, "stream-raw"), scratch_path(spark, "stream-lake")
    trips = tables.trips(spark, sf_dir).withColumn("year", F.year(PICKUP))
    early = F.col("year") <= INT64_LOCATION_YEAR
    trips.filter(early).write.partitionBy("year").parquet(raw)
    ingest_available(spark, raw, lake_root, excluded_locations=tables.FIXTURE_EXCLUDED_LOCATIONS)
    trips.filter(~early).write.mode("append").partitionBy("year").parquet(raw)
    ingest_available(spark, raw, lake_root, excluded_locations=tables.FIXTURE_EXCLUDED_LOCATIONS)
    return Lakehouse.at(spark, lake_root).silver.as_of()


def _landing_frames(spark: SparkSession, sf_dir: str):
    """Plan = every month of every order year; landed = months that have orders.

    The run date is the first day after the last order month.
    """
    orders = tables.table(spark, sf_dir, "orders")
    last = scalar(orders.agg(F.max("o_orderdate")))
    run_date = (last.replace(day=28) + dt.timedelta(days=4)).replace(day=1).date()
    years = orders.select(F.year("o_orderdate").alias("data_year")).distinct()
    plan = month_plan(months_of_years(years), run_date)
    landed = orders.select(
        F.year("o_orderdate").cast("int").alias("data_year"),
        F.month("o_orderdate").cast("int").alias("data_month"),
    ).distinct()
    return plan, landed


def q_landing_month_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-mode plan: file name, object key and pending flag of every month."""
    plan, _ = _landing_frames(spark, sf_dir)
    return plan


def q_landing_missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned months with no landed data (skip-already-landed, as an anti join)."""
    plan, landed = _landing_frames(spark, sf_dir)
    return missing_months(plan, landed)


def q_landing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months per status and the derived run status."""
    plan, landed = _landing_frames(spark, sf_dir)
    return landing_report(landing_status(plan, landed))


def q_landing_previous_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly mode: the plan of the month before the last order's month."""
    last = scalar(tables.table(spark, sf_dir, "orders").agg(F.max("o_orderdate")))
    return month_plan(previous_month(spark, last.date()), last.date())


def q_landing_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months per outcome of a landing run, and the run's status.

    Of the months with orders: the first year landed before and is not planned,
    a March vanishes during the run, a February fails and a March is missing in
    the last year but one; months without orders yet are pending.
    """
    plan, landed = _landing_frames(spark, sf_dir)
    bounds = landed.agg(F.min("data_year").alias("first"), F.max("data_year").alias("last")).first()
    year, month = F.col("data_year"), F.col("data_month")
    plan = plan.filter(year > bounds["first"])
    before = landed.filter(year <= bounds["first"] + 2)
    failed = (year == bounds["last"] - 1) & (month == 2)
    gone = (year == bounds["first"] + 1) & (month == 3)
    after = landed.filter(~failed & ~gone & ~((year == bounds["last"] - 1) & (month == 3)))
    errors = landed.filter(failed).withColumn("error", F.lit("HTTP 404"))
    return outcome_report(landing_outcomes(plan, before, after, errors))


QUERIES: dict[str, Query] = {
    "monthly_borough_agg": q_monthly_borough_agg,
    "monthly_borough_agg_sql": q_monthly_borough_agg_sql,
    "dq_global_filter": q_dq_global_filter,
    "dq_rate_rules": q_dq_rate_rules,
    "dq_reject_reasons": q_dq_reject_reasons,
    "dq_reject_reasons_faulty": q_dq_reject_reasons_faulty,
    "dq_clean_faulty": q_dq_clean_faulty,
    "zone_enrich_left_join": q_zone_enrich_left_join,
    "trip_key_hash": q_trip_key_hash,
    "calendar_parts": q_calendar_parts,
    "gold_obt_projection": q_gold_obt_projection,
    "silver_row_count": q_silver_row_count,
    "high_water_mark": q_high_water_mark,
    "bronze_incremental": q_bronze_incremental,
    "top_borough_pairs": q_top_borough_pairs,
    "demand_by_hour_dow": q_demand_by_hour_dow,
    "demand_by_zone": q_demand_by_zone,
    "latest_two_commits": q_latest_two_commits,
    "snapshot_as_of": q_snapshot_as_of,
    "snapshot_incremental": q_snapshot_incremental,
    "read_plan_decision": q_read_plan_decision,
    "merge_upsert_trips": q_merge_upsert_trips,
    "merge_partial_aggs": q_merge_partial_aggs,
    "merge_monthly_agg": q_merge_monthly_agg,
    "agg_signed_deltas": q_agg_signed_deltas,
    "incremental_load_effect": q_incremental_load_effect,
    "late_rows_load": q_late_rows_load,
    "pipeline_end_to_end": q_pipeline_end_to_end,
    "agg_first_run": q_agg_first_run,
    "gold_empty_delta": q_gold_empty_delta,
    "silver_sorted_write": q_silver_sorted_write,
    "zone_csv_scan": q_zone_csv_scan,
    "bronze_drift_read": q_bronze_drift_read,
    "schema_drift": q_schema_drift,
    "landing_month_plan": q_landing_month_plan,
    "landing_missing_months": q_landing_missing_months,
    "landing_report": q_landing_report,
    "landing_previous_month": q_landing_previous_month,
    "landing_outcomes": q_landing_outcomes,
    "stream_ingest_silver": q_stream_ingest_silver,
    "gold_single_precision": q_gold_single_precision,
    "cast_accepted": q_cast_accepted,
    "cast_rejects": q_cast_rejects,
    "silver_sort_check": q_silver_sort_check,
    "named_table_select": q_named_table_select,
    "bronze_new_files": q_bronze_new_files,
}

ORACLES: dict[str, str] = {
    "monthly_borough_agg": sql.MONTHLY_BOROUGH_AGG,
    "monthly_borough_agg_sql": sql.MONTHLY_BOROUGH_AGG,
    "dq_global_filter": sql.DQ_GLOBAL_FILTER,
    "dq_rate_rules": sql.DQ_RATE_RULES,
    "dq_reject_reasons": sql.DQ_REJECT_REASONS,
    "dq_reject_reasons_faulty": sql.DQ_REJECT_REASONS_FAULTY,
    "dq_clean_faulty": sql.DQ_CLEAN_FAULTY,
    "zone_enrich_left_join": sql.ZONE_ENRICH_LEFT_JOIN,
    "trip_key_hash": sql.TRIP_KEY_HASH,
    "calendar_parts": sql.CALENDAR_PARTS,
    "gold_obt_projection": sql.GOLD_OBT_PROJECTION,
    "silver_row_count": sql.SILVER_ROW_COUNT,
    "high_water_mark": sql.HIGH_WATER_MARK,
    "bronze_incremental": sql.BRONZE_INCREMENTAL,
    "top_borough_pairs": sql.TOP_BOROUGH_PAIRS,
    "demand_by_hour_dow": sql.DEMAND_BY_HOUR_DOW,
    "demand_by_zone": sql.DEMAND_BY_ZONE,
    "latest_two_commits": sql.LATEST_TWO_COMMITS,
    "snapshot_as_of": sql.SNAPSHOT_AS_OF,
    "snapshot_incremental": sql.SNAPSHOT_INCREMENTAL,
    "read_plan_decision": sql.READ_PLAN_DECISION,
    "merge_upsert_trips": sql.MERGE_UPSERT_TRIPS,
    "merge_partial_aggs": sql.MONTHLY_BOROUGH_AGG,
    "merge_monthly_agg": sql.MERGE_MONTHLY_AGG,
    "agg_signed_deltas": sql.AGG_SIGNED_DELTAS,
    "incremental_load_effect": sql.INCREMENTAL_LOAD_EFFECT,
    "late_rows_load": sql.LATE_ROWS_LOAD,
    "pipeline_end_to_end": sql.MONTHLY_BOROUGH_AGG,
    "agg_first_run": sql.MONTHLY_BOROUGH_AGG,
    "gold_empty_delta": sql.GOLD_OBT_PROJECTION,
    "silver_sorted_write": sql.SILVER_SORTED_WRITE,
    "zone_csv_scan": sql.ZONE_CSV_SCAN,
    "bronze_drift_read": sql.BRONZE_DRIFT_READ,
    "schema_drift": sql.SCHEMA_DRIFT,
    "landing_month_plan": sql.LANDING_MONTH_PLAN,
    "landing_missing_months": sql.LANDING_MISSING_MONTHS,
    "landing_report": sql.LANDING_REPORT,
    "landing_previous_month": sql.LANDING_PREVIOUS_MONTH,
    "landing_outcomes": sql.LANDING_OUTCOMES,
    "stream_ingest_silver": sql.SILVER_SORTED_WRITE,
    "gold_single_precision": sql.GOLD_SINGLE_PRECISION,
    "cast_accepted": sql.CAST_ACCEPTED,
    "cast_rejects": sql.CAST_REJECTS,
    "silver_sort_check": sql.SILVER_SORT_CHECK,
    "named_table_select": sql.MONTHLY_BOROUGH_AGG,
    "bronze_new_files": sql.BRONZE_NEW_FILES,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
