"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written by hand from the rule definitions, not generated from the Spark code,
so a mistake in one is caught by the other.  Sums of money/distances are taken
as exact decimals on this side; the Spark side rounds its double sums to cents.
"""

from __future__ import annotations

TRIPS = """
trips AS (
  SELECT
    CAST(1 + l_linenumber % 2 AS INT) AS VendorID,
    o_orderdate AS tpep_pickup_datetime,
    l_shipdate AS tpep_dropoff_datetime,
    CAST(l_quantity AS BIGINT) AS passenger_count,
    l_quantity AS trip_distance,
    CAST(1 + l_partkey % 7 AS BIGINT) AS RatecodeID,
    l_returnflag AS store_and_fwd_flag,
    CAST(c_nationkey AS INT) AS PULocationID,
    CAST(s_nationkey AS INT) AS DOLocationID,
    CAST(1 + l_linenumber % 3 AS BIGINT) AS payment_type,
    l_extendedprice AS fare_amount,
    CAST(0.0 AS DOUBLE) AS extra,
    CASE WHEN l_tax <= 0.05 THEN CAST(0.5 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS mta_tax,
    CAST(0.0 AS DOUBLE) AS tip_amount,
    CAST(0.0 AS DOUBLE) AS tolls_amount,
    CASE WHEN l_discount <= 0.07 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END AS improvement_surcharge,
    l_extendedprice AS total_amount,
    CASE WHEN l_linestatus = 'O' THEN CAST(2.5 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS congestion_surcharge,
    CAST(0.0 AS DOUBLE) AS Airport_fee,
    CASE WHEN l_returnflag = 'R' THEN CAST(NULL AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END AS cbd_congestion_fee
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

GLOBAL_OK = """(
  PULocationID IS NOT NULL AND PULocationID <> 0
  AND DOLocationID IS NOT NULL AND DOLocationID <> 0
  AND PULocationID NOT IN (23, 24) AND DOLocationID NOT IN (23, 24)
  AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
  AND tpep_dropoff_datetime > tpep_pickup_datetime
  AND total_amount > 0 AND trip_distance >= 0
  AND payment_type IN (1, 2)
)"""

RATE_OK = """(
  RatecodeID IN (1, 2, 3, 4, 5) AND CASE
    WHEN RatecodeID = 1 THEN improvement_surcharge = 1.0 AND mta_tax IN (0.0, 0.5)
      AND congestion_surcharge IN (0.0, 2.5) AND fare_amount >= 3.0
      AND cbd_congestion_fee IN (0.0, 0.75)
    WHEN RatecodeID = 2 THEN Airport_fee >= 0.0 AND mta_tax IN (0.0, 0.5)
      AND improvement_surcharge IN (0.0, 1.0) AND congestion_surcharge IN (0.0, 2.5)
      AND cbd_congestion_fee IN (0.0, 0.75)
    WHEN RatecodeID = 3 THEN fare_amount >= 0.0 AND improvement_surcharge >= 0.0
    WHEN RatecodeID = 4 THEN mta_tax = 0.5 AND improvement_surcharge = 1.0
      AND congestion_surcharge IN (0.0, 2.5) AND cbd_congestion_fee IN (0.0, 0.75)
    WHEN RatecodeID = 5 THEN mta_tax IN (0.0, 0.5) AND improvement_surcharge = 1.0
      AND congestion_surcharge IN (0.0, 2.5) AND cbd_congestion_fee IN (0.0, 0.75)
    ELSE FALSE END
)"""

CLEAN = f"""
clean AS (SELECT * FROM trips WHERE {GLOBAL_OK} AND {RATE_OK})"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS INT) AS LocationID, r_name AS Borough, n_name AS Zone,
         'Z' AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey < 20
)"""

TRIP_ID = """sha256(concat_ws('|', CAST(VendorID AS VARCHAR),
    CAST(tpep_pickup_datetime AS VARCHAR), CAST(tpep_dropoff_datetime AS VARCHAR),
    CAST(PULocationID AS VARCHAR), CAST(DOLocationID AS VARCHAR)))"""


def gold_select(source: str, created_at: str) -> str:
    """SELECT producing the 24 gold columns from an enriched-able silver CTE."""
    return f"""
  SELECT
    {TRIP_ID} AS trip_id,
    VendorID AS vendor_id,
    tpep_pickup_datetime AS pickup_datetime,
    tpep_dropoff_datetime AS dropoff_datetime,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    CAST(year(tpep_pickup_datetime) AS INT) AS pickup_year,
    CAST(month(tpep_pickup_datetime) AS INT) AS pickup_month,
    CAST(day(tpep_pickup_datetime) AS INT) AS pickup_day,
    dayname(tpep_pickup_datetime) AS pickup_day_of_week,
    CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour,
    PULocationID AS pickup_location_id,
    pz.Zone AS pickup_zone,
    pz.Borough AS pickup_borough,
    DOLocationID AS dropoff_location_id,
    dz.Zone AS dropoff_zone,
    dz.Borough AS dropoff_borough,
    CAST(passenger_count AS INT) AS passenger_count,
    trip_distance,
    total_amount,
    CAST(payment_type AS INT) AS payment_type,
    CAST(RatecodeID AS INT) AS rate_code_id,
    store_and_fwd_flag,
    'yellow_taxi' AS data_source,
    {created_at} AS created_at
  FROM {source} s
  LEFT JOIN zones pz ON s.PULocationID = pz.LocationID
  LEFT JOIN zones dz ON s.DOLocationID = dz.LocationID"""


GOLD = f"""
gold AS ({gold_select('clean', "TIMESTAMP '2024-01-01 00:00:00'")})"""


def money(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


AGG_SELECT = f"""
  SELECT pickup_year, pickup_month, pickup_borough, dropoff_borough,
         COUNT(trip_id) AS total_trips,
         {money('total_amount')} AS total_revenue,
         {money('trip_distance')} AS total_trip_distance,
         CAST(SUM(passenger_count) AS BIGINT) AS total_passengers"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


MONTHLY_BOROUGH_AGG = f"""
{with_(TRIPS, CLEAN, ZONES, GOLD)}
{AGG_SELECT}
FROM gold
GROUP BY pickup_year, pickup_month, pickup_borough, dropoff_borough
"""

DQ_GLOBAL_FILTER = f"""
{with_(TRIPS)}
SELECT * FROM trips WHERE {GLOBAL_OK}
"""

DQ_RATE_RULES = f"""
{with_(TRIPS)}
SELECT * FROM trips WHERE {RATE_OK}
"""

DQ_REJECT_REASONS = f"""
{with_(TRIPS)}
SELECT reject_reason, COUNT(*) AS rejected_rows
FROM (
  SELECT CASE
    WHEN (PULocationID IS NOT NULL AND PULocationID <> 0) IS NOT TRUE THEN 'F01_pickup_location_present'
    WHEN (DOLocationID IS NOT NULL AND DOLocationID <> 0) IS NOT TRUE THEN 'F02_dropoff_location_present'
    WHEN (PULocationID NOT IN (23, 24)) IS NOT TRUE THEN 'F03_pickup_location_known'
    WHEN (DOLocationID NOT IN (23, 24)) IS NOT TRUE THEN 'F04_dropoff_location_known'
    WHEN (tpep_pickup_datetime IS NOT NULL) IS NOT TRUE THEN 'F05_pickup_time_present'
    WHEN (tpep_dropoff_datetime IS NOT NULL) IS NOT TRUE THEN 'F06_dropoff_time_present'
    WHEN (tpep_dropoff_datetime > tpep_pickup_datetime) IS NOT TRUE THEN 'F07_dropoff_after_pickup'
    WHEN (total_amount > 0) IS NOT TRUE THEN 'F08_total_amount_positive'
    WHEN (trip_distance >= 0) IS NOT TRUE THEN 'F09_trip_distance_not_negative'
    WHEN (payment_type IN (1, 2)) IS NOT TRUE THEN 'F10_payment_type_accepted'
    WHEN (RatecodeID IN (1, 2, 3, 4, 5)) IS NOT TRUE THEN 'F11_rate_code_known'
    WHEN (RatecodeID <> 1 OR (improvement_surcharge = 1.0 AND mta_tax IN (0.0, 0.5)
          AND congestion_surcharge IN (0.0, 2.5) AND fare_amount >= 3.0
          AND cbd_congestion_fee IN (0.0, 0.75))) IS NOT TRUE THEN 'F12_rate_1_fees'
    WHEN (RatecodeID <> 2 OR (Airport_fee >= 0.0 AND mta_tax IN (0.0, 0.5)
          AND improvement_surcharge IN (0.0, 1.0) AND congestion_surcharge IN (0.0, 2.5)
          AND cbd_congestion_fee IN (0.0, 0.75))) IS NOT TRUE THEN 'F13_rate_2_fees'
    WHEN (RatecodeID <> 3 OR (fare_amount >= 0.0 AND improvement_surcharge >= 0.0))
          IS NOT TRUE THEN 'F14_rate_3_fees'
    WHEN (RatecodeID <> 4 OR (mta_tax = 0.5 AND improvement_surcharge = 1.0
          AND congestion_surcharge IN (0.0, 2.5) AND cbd_congestion_fee IN (0.0, 0.75)))
          IS NOT TRUE THEN 'F15_rate_4_fees'
    WHEN (RatecodeID <> 5 OR (mta_tax IN (0.0, 0.5) AND improvement_surcharge = 1.0
          AND congestion_surcharge IN (0.0, 2.5) AND cbd_congestion_fee IN (0.0, 0.75)))
          IS NOT TRUE THEN 'F16_rate_5_fees'
  END AS reject_reason
  FROM trips
) r
WHERE reject_reason IS NOT NULL
GROUP BY reject_reason
"""

ZONE_ENRICH_LEFT_JOIN = f"""
{with_(TRIPS, ZONES)}
SELECT t.*, pz.Zone AS pickup_zone, pz.Borough AS pickup_borough,
       dz.Zone AS dropoff_zone, dz.Borough AS dropoff_borough
FROM trips t
LEFT JOIN zones pz ON t.PULocationID = pz.LocationID
LEFT JOIN zones dz ON t.DOLocationID = dz.LocationID
"""

TRIP_KEY_HASH = f"""
{with_(TRIPS)}
SELECT {TRIP_ID} AS trip_id, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
       PULocationID, DOLocationID
FROM trips
"""

CALENDAR_PARTS = """
SELECT event_id,
       CAST(ts AS DATE) AS event_date,
       CAST(year(ts) AS INT) AS event_year,
       CAST(month(ts) AS INT) AS event_month,
       CAST(day(ts) AS INT) AS event_day,
       dayname(ts) AS event_day_of_week,
       CAST(hour(ts) AS INT) AS event_hour
FROM events
"""

GOLD_OBT_PROJECTION = f"""
{with_(TRIPS, CLEAN, ZONES, GOLD)}
SELECT * FROM gold
"""

SILVER_ROW_COUNT = f"""
{with_(TRIPS)}
SELECT COUNT(*) AS bronze_rows,
       COUNT(*) FILTER (WHERE {GLOBAL_OK} AND {RATE_OK}) AS silver_rows
FROM trips
"""

SILVER_BEFORE_2000 = """
silver AS (SELECT * FROM clean WHERE tpep_pickup_datetime < TIMESTAMP '2000-01-01 00:00:00')"""

HIGH_WATER_MARK = f"""
{with_(TRIPS, CLEAN, SILVER_BEFORE_2000)}
SELECT MAX(tpep_pickup_datetime) AS watermark FROM silver
"""

BRONZE_INCREMENTAL = f"""
{with_(TRIPS, CLEAN, SILVER_BEFORE_2000)}
SELECT * FROM trips
WHERE tpep_pickup_datetime > (SELECT MAX(tpep_pickup_datetime) FROM silver)
"""

TOP_BOROUGH_PAIRS = f"""
{with_(TRIPS, CLEAN, ZONES, GOLD)}
SELECT * FROM (
  SELECT pickup_borough, dropoff_borough,
         COUNT(trip_id) AS total_trips,
         {money('total_amount')} AS total_revenue,
         CAST(row_number() OVER (ORDER BY COUNT(trip_id) DESC,
              pickup_borough ASC NULLS FIRST, dropoff_borough ASC NULLS FIRST) AS INT) AS pair_rank
  FROM gold
  GROUP BY pickup_borough, dropoff_borough
) ranked
WHERE pair_rank <= 10
"""

DEMAND_BY_HOUR_DOW = """
SELECT dayname(ts) AS day_of_week,
       CAST(hour(ts) AS INT) AS hour_of_day,
       COUNT(*) AS events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events
GROUP BY dayname(ts), hour(ts)
"""

HISTORY = """
committed AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
         CAST(year(o_orderdate) - 1994 AS BIGINT) AS commit_id
  FROM orders
),
log AS (
  SELECT commit_id,
         CASE WHEN commit_id = 4 THEN 'overwrite' ELSE 'append' END AS operation,
         MAX(o_orderdate) AS committed_at,
         COUNT(*) AS delta_rows
  FROM committed GROUP BY commit_id
)"""

LATEST_TWO_COMMITS = f"""
{with_(HISTORY)}
SELECT commit_id AS snapshot_id, operation, committed_at
FROM log ORDER BY committed_at DESC, commit_id DESC LIMIT 2
"""

# As of commit 6: the newest overwrite at or before 6 is commit 4.
SNAPSHOT_AS_OF = f"""
{with_(HISTORY)}
SELECT * FROM committed WHERE commit_id BETWEEN 4 AND 6
"""

# Appends in (2, 7]: commits 3, 5, 6, 7 (4 is an overwrite).
SNAPSHOT_INCREMENTAL = f"""
{with_(HISTORY)}
SELECT * FROM committed WHERE commit_id > 2 AND commit_id <= 7 AND commit_id <> 4
"""

READ_PLAN_DECISION = f"""
{with_(HISTORY)},
p AS (
  SELECT *, LAG(commit_id) OVER (ORDER BY committed_at, commit_id) AS previous_id,
         (LAG(commit_id) OVER (ORDER BY committed_at, commit_id) IS NULL
          OR operation IN ('overwrite', 'delete', 'replace')
          OR delta_rows = 0) AS is_full
  FROM log
)
SELECT commit_id AS snapshot_id, operation,
       CASE WHEN is_full THEN 'full' ELSE 'delta' END AS read_mode,
       CASE WHEN is_full THEN NULL ELSE previous_id END AS start_snapshot_id,
       commit_id AS end_snapshot_id
FROM p
"""

MERGE_WINDOWS = """
clean_old AS (SELECT * FROM clean WHERE tpep_pickup_datetime < TIMESTAMP '2000-01-01 00:00:00'),
clean_new AS (SELECT * FROM clean WHERE tpep_pickup_datetime >= TIMESTAMP '1998-01-01 00:00:00')"""

MERGE_UPSERT_TRIPS = f"""
{with_(TRIPS, CLEAN, ZONES, MERGE_WINDOWS)},
t AS ({gold_select('clean_old', "TIMESTAMP '2024-01-01 00:00:00'")}),
s AS ({gold_select('clean_new', "TIMESTAMP '2024-02-01 00:00:00'")})
SELECT s.* EXCLUDE (created_at), COALESCE(t.created_at, s.created_at) AS created_at
FROM s LEFT JOIN t ON s.trip_id = t.trip_id
UNION ALL
SELECT * FROM t WHERE trip_id NOT IN (SELECT trip_id FROM s)
"""

MERGE_MONTHLY_AGG = f"""
{with_(TRIPS, CLEAN, ZONES)},
clean_old AS (SELECT * FROM clean WHERE tpep_pickup_datetime < TIMESTAMP '2000-01-01 00:00:00'),
clean_new AS (SELECT * FROM clean WHERE tpep_pickup_datetime >= TIMESTAMP '1999-01-01 00:00:00'),
gold_old AS ({gold_select('clean_old', "TIMESTAMP '2024-01-01 00:00:00'")}),
gold_new AS ({gold_select('clean_new', "TIMESTAMP '2024-01-01 00:00:00'")}),
t AS ({AGG_SELECT} FROM gold_old GROUP BY ALL),
s AS ({AGG_SELECT} FROM gold_new GROUP BY ALL)
SELECT * FROM s
UNION ALL
SELECT * FROM t WHERE NOT EXISTS (
  SELECT 1 FROM s
  WHERE s.pickup_year IS NOT DISTINCT FROM t.pickup_year
    AND s.pickup_month IS NOT DISTINCT FROM t.pickup_month
    AND s.pickup_borough IS NOT DISTINCT FROM t.pickup_borough
    AND s.dropoff_borough IS NOT DISTINCT FROM t.dropoff_borough
)
"""

INCREMENTAL_LOAD_EFFECT = f"""
{with_(TRIPS, CLEAN, SILVER_BEFORE_2000)},
added AS (
  SELECT * FROM clean
  WHERE tpep_pickup_datetime > (SELECT MAX(tpep_pickup_datetime) FROM silver)
)
SELECT (SELECT COUNT(*) FROM silver) AS rows_before,
       (SELECT COUNT(*) FROM added) AS rows_added,
       (SELECT COUNT(*) FROM silver) + (SELECT COUNT(*) FROM added) AS rows_after
"""

SILVER_SORTED_WRITE = f"""
{with_(TRIPS, CLEAN)}
SELECT * FROM clean
"""

ZONE_CSV_SCAN = """
SELECT CAST(n_nationkey AS INT) AS LocationID, r_name AS Borough, n_name AS Zone, 'Z' AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

BRONZE_DRIFT_READ = f"""
{with_(TRIPS)}
SELECT * REPLACE (
  CASE WHEN year(tpep_pickup_datetime) = 1995 THEN CAST(NULL AS DOUBLE)
       ELSE cbd_congestion_fee END AS cbd_congestion_fee)
FROM trips
"""

# The landed files as catalog.py writes them: 1995 lacks the CBD fee, 1996 stores int64 location ids.
SCHEMA_DRIFT = f"""
{with_(TRIPS)},
landed AS (SELECT DISTINCT year(tpep_pickup_datetime) AS y FROM trips),
wanted (name, kind) AS (VALUES
  ('VendorID', 'int32'), ('tpep_pickup_datetime', 'timestamp[us]'), ('tpep_dropoff_datetime', 'timestamp[us]'),
  ('passenger_count', 'int64'), ('trip_distance', 'double'), ('RatecodeID', 'int64'),
  ('store_and_fwd_flag', 'string'), ('PULocationID', 'int32'), ('DOLocationID', 'int32'),
  ('payment_type', 'int64'), ('fare_amount', 'double'), ('extra', 'double'), ('mta_tax', 'double'),
  ('tip_amount', 'double'), ('tolls_amount', 'double'), ('improvement_surcharge', 'double'),
  ('total_amount', 'double'), ('congestion_surcharge', 'double'), ('Airport_fee', 'double'),
  ('cbd_congestion_fee', 'double')),
stored AS (
  SELECT name, kind, y,
         CASE WHEN name IN ('PULocationID', 'DOLocationID') AND y = 1996 THEN 'int64' ELSE kind END AS found
  FROM wanted CROSS JOIN landed
  WHERE NOT (name = 'cbd_congestion_fee' AND y = 1995))
SELECT name AS "column", COUNT(*) AS folders, string_agg(DISTINCT found, ',' ORDER BY found) AS types,
       kind AS expected_type,
       CASE WHEN COUNT(*) < (SELECT COUNT(*) FROM landed) THEN 'missing'
            WHEN COUNT(DISTINCT found) > 1 OR MIN(found) <> kind THEN 'retyped' ELSE 'ok' END AS drift
FROM stored
GROUP BY name, kind
"""

LANDING = """
years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS data_year FROM orders),
run AS (
  SELECT CAST(date_trunc('month', MAX(o_orderdate)) + INTERVAL 1 MONTH AS DATE) AS run_date
  FROM orders
),
months AS (
  SELECT data_year, CAST(unnest(range(1, 13)) AS INT) AS data_month FROM years
),
plan AS (
  SELECT data_year, data_month,
         printf('yellow_tripdata_%04d-%02d.parquet', data_year, data_month) AS file_name,
         'raw/taxi/year=' || CAST(year((SELECT run_date FROM run)) AS VARCHAR) || '/'
           || printf('yellow_tripdata_%04d-%02d.parquet', data_year, data_month) AS object_key,
         CAST(year((SELECT run_date FROM run)) AS INT) AS landed_year,
         (data_year * 12 + data_month)
           >= (year((SELECT run_date FROM run)) * 12 + month((SELECT run_date FROM run))) AS pending
  FROM months
),
landed AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS data_year,
                  CAST(month(o_orderdate) AS INT) AS data_month
  FROM orders
)"""

LANDING_MONTH_PLAN = f"""
{with_(LANDING)}
SELECT * FROM plan
"""

LANDING_MISSING_MONTHS = f"""
{with_(LANDING)}
SELECT p.* FROM plan p
WHERE NOT EXISTS (
  SELECT 1 FROM landed l WHERE l.data_year = p.data_year AND l.data_month = p.data_month
)
"""

LANDING_REPORT = f"""
{with_(LANDING)},
status AS (
  SELECT CASE
           WHEN l.data_year IS NOT NULL THEN 'skipped'
           WHEN p.pending THEN 'pending'
           ELSE 'missing'
         END AS status
  FROM plan p
  LEFT JOIN landed l ON l.data_year = p.data_year AND l.data_month = p.data_month
),
counts AS (SELECT status, COUNT(*) AS months FROM status GROUP BY status)
SELECT status, months,
       CASE WHEN (SELECT COUNT(*) FROM counts WHERE status = 'missing') > 0
            THEN 'incomplete' ELSE 'completed' END AS run_status
FROM counts
"""

DEMAND_BY_ZONE = f"""
{with_(TRIPS, CLEAN, ZONES, GOLD)}
SELECT pickup_borough, pickup_zone,
       COUNT(trip_id) AS total_trips,
       {money('total_amount')} AS total_revenue,
       CAST(round(SUM(CAST(total_amount AS DECIMAL(18,2))) / COUNT(trip_id), 2) AS DOUBLE) AS avg_revenue
FROM gold
GROUP BY pickup_borough, pickup_zone
"""

FAULTY = """
faulty AS (
  SELECT * REPLACE (
    CASE WHEN passenger_count = 1 THEN NULL ELSE PULocationID END AS PULocationID,
    CASE WHEN passenger_count = 2 THEN 0 ELSE DOLocationID END AS DOLocationID,
    CASE WHEN passenger_count = 3 THEN NULL ELSE tpep_pickup_datetime END AS tpep_pickup_datetime,
    CASE WHEN passenger_count = 4 THEN NULL ELSE tpep_dropoff_datetime END AS tpep_dropoff_datetime,
    CASE WHEN passenger_count = 5 THEN CAST(0 AS DOUBLE) ELSE total_amount END AS total_amount,
    CASE WHEN passenger_count = 6 THEN CAST(-1 AS DOUBLE) ELSE trip_distance END AS trip_distance,
    CASE WHEN passenger_count = 7 THEN 3 ELSE RatecodeID END AS RatecodeID,
    CASE WHEN passenger_count = 7 THEN CAST(-1 AS DOUBLE) ELSE fare_amount END AS fare_amount)
  FROM trips
)"""

DQ_REJECT_REASONS_FAULTY = DQ_REJECT_REASONS.replace(with_(TRIPS), with_(TRIPS, FAULTY)).replace("FROM trips", "FROM faulty")
DQ_REJECT_REASONS_FAULTY = DQ_REJECT_REASONS_FAULTY.replace("FROM faulty\n)", "FROM trips\n)", 1)

DQ_CLEAN_FAULTY = f"""
{with_(TRIPS, FAULTY)}
SELECT * FROM faulty WHERE {GLOBAL_OK} AND {RATE_OK}
"""

GOLD_SINGLE_PRECISION = f"""
{with_(TRIPS, CLEAN, ZONES, GOLD)}
SELECT * REPLACE (CAST(trip_distance AS FLOAT) AS trip_distance, CAST(total_amount AS FLOAT) AS total_amount) FROM gold
"""

CAST_ACCEPTED = f"""
{with_(TRIPS)}
SELECT * REPLACE (CAST(passenger_count * 100000000 AS INT) AS passenger_count, CAST(payment_type AS INT) AS payment_type,
                  CAST(RatecodeID AS TINYINT) AS RatecodeID)
FROM trips WHERE passenger_count * 100000000 <= 2147483647 AND payment_type <> 3
"""

CAST_REJECTS = f"""
{with_(TRIPS)}
SELECT CASE WHEN passenger_count * 100000000 <= 2147483647 THEN 'payment_type'
            WHEN payment_type <> 3 THEN 'passenger_count' ELSE 'passenger_count,payment_type' END AS rejected_columns,
       COUNT(*) AS rejected_rows
FROM trips WHERE passenger_count * 100000000 > 2147483647 OR payment_type = 3
GROUP BY ALL
"""

AGG_SIGNED_DELTAS = f"""
{with_(TRIPS, CLEAN, ZONES, MERGE_WINDOWS)},
t AS ({gold_select('clean_old', "TIMESTAMP '2024-01-01 00:00:00'")}),
s AS (SELECT * REPLACE (lower(pickup_borough) AS pickup_borough, total_amount + 10 AS total_amount,
             CASE WHEN passenger_count % 5 > 0 THEN passenger_count END AS passenger_count)
      FROM ({gold_select('clean_new', "TIMESTAMP '2024-01-01 00:00:00'")})),
merged AS (SELECT * FROM s UNION ALL SELECT * FROM t WHERE trip_id NOT IN (SELECT trip_id FROM s))
{AGG_SELECT}
FROM merged
GROUP BY pickup_year, pickup_month, pickup_borough, dropoff_borough
"""

LATE_ROWS_LOAD = f"""
{with_(TRIPS, CLEAN)},
mark AS (SELECT MAX(tpep_pickup_datetime) AS w FROM clean
         WHERE tpep_pickup_datetime < TIMESTAMP '2000-01-01 00:00:00' AND VendorID <> 2)
SELECT clean.* FROM clean, mark
WHERE tpep_pickup_datetime > w OR VendorID <> 2 OR tpep_pickup_datetime > w - INTERVAL 400 DAY
"""

SILVER_SORT_CHECK = f"""
{with_(TRIPS, CLEAN)}
SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS violations FROM clean
"""

BRONZE_NEW_FILES = f"""
{with_(TRIPS)}
SELECT * FROM trips WHERE year(tpep_pickup_datetime) > 1996
"""

LANDING_PREVIOUS_MONTH = """
WITH run AS (SELECT CAST(MAX(o_orderdate) AS DATE) AS run_date FROM orders),
prev AS (SELECT run_date, date_trunc('month', run_date) - INTERVAL 1 MONTH AS m FROM run)
SELECT CAST(year(m) AS INT) AS data_year, CAST(month(m) AS INT) AS data_month,
       printf('yellow_tripdata_%04d-%02d.parquet', year(m), month(m)) AS file_name,
       'raw/taxi/year=' || CAST(year(run_date) AS VARCHAR) || '/'
         || printf('yellow_tripdata_%04d-%02d.parquet', year(m), month(m)) AS object_key,
       CAST(year(run_date) AS INT) AS landed_year,
       FALSE AS pending
FROM prev
"""

LANDING_OUTCOMES = f"""
{with_(LANDING)},
b AS (SELECT MIN(data_year) AS lo, MAX(data_year) AS hi FROM landed),
seen AS (
  SELECT data_year, data_month, data_year <= lo + 2 AS was,
         NOT (data_year = hi - 1 AND data_month IN (2, 3)) AND NOT (data_year = lo + 1 AND data_month = 3) AS now,
         data_year = hi - 1 AND data_month = 2 AS failed
  FROM landed, b
),
months_seen AS (
  SELECT p.pending, p.data_year IS NOT NULL AS planned, coalesce(was, FALSE) AS was, coalesce(now, FALSE) AS now,
         coalesce(failed, FALSE) AS failed
  FROM (SELECT plan.* FROM plan, b WHERE data_year > lo) p
  FULL JOIN seen s ON s.data_year = p.data_year AND s.data_month = p.data_month
  WHERE p.data_year IS NOT NULL OR was OR now
),
counts AS (
  SELECT CASE WHEN was AND NOT now THEN 'lost' WHEN NOT planned THEN 'unplanned' WHEN was THEN 'skipped'
              WHEN now THEN 'success' WHEN failed THEN 'failed' WHEN pending THEN 'pending' ELSE 'missing' END AS status,
         COUNT(*) AS months
  FROM months_seen GROUP BY ALL
)
SELECT status, months,
       CASE WHEN (SELECT COUNT(*) FROM counts WHERE status IN ('failed', 'lost')) > 0 THEN 'failed'
            WHEN (SELECT COUNT(*) FROM counts WHERE status = 'missing') > 0 THEN 'incomplete' ELSE 'completed' END AS run_status
FROM counts
"""
