"""Table schemas of the trip lakehouse: bronze/silver trips, zones, gold, aggregate."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# Silver = bronze columns with their declared types (20 columns).
SILVER = _struct(
    ("VendorID", IntegerType()),
    ("tpep_pickup_datetime", TimestampNTZType()),
    ("tpep_dropoff_datetime", TimestampNTZType()),
    ("passenger_count", LongType()),
    ("trip_distance", DoubleType()),
    ("RatecodeID", LongType()),
    ("store_and_fwd_flag", StringType()),
    ("PULocationID", IntegerType()),
    ("DOLocationID", IntegerType()),
    ("payment_type", LongType()),
    ("fare_amount", DoubleType()),
    ("extra", DoubleType()),
    ("mta_tax", DoubleType()),
    ("tip_amount", DoubleType()),
    ("tolls_amount", DoubleType()),
    ("improvement_surcharge", DoubleType()),
    ("total_amount", DoubleType()),
    ("congestion_surcharge", DoubleType()),
    ("Airport_fee", DoubleType()),
    ("cbd_congestion_fee", DoubleType()),
)

# Bronze is read with the silver schema so that files lacking a column yield
# NULLs instead of silently dropping it (one footer would otherwise decide).
BRONZE = SILVER

SILVER_COLUMNS = [f.name for f in SILVER.fields]

ZONES = _struct(
    ("LocationID", IntegerType()),
    ("Borough", StringType()),
    ("Zone", StringType()),
    ("service_zone", StringType()),
)

GOLD = _struct(
    ("trip_id", StringType()),
    ("vendor_id", IntegerType()),
    ("pickup_datetime", TimestampNTZType()),
    ("dropoff_datetime", TimestampNTZType()),
    ("pickup_date", DateType()),
    ("pickup_year", IntegerType()),
    ("pickup_month", IntegerType()),
    ("pickup_day", IntegerType()),
    ("pickup_day_of_week", StringType()),
    ("pickup_hour", IntegerType()),
    ("pickup_location_id", IntegerType()),
    ("pickup_zone", StringType()),
    ("pickup_borough", StringType()),
    ("dropoff_location_id", IntegerType()),
    ("dropoff_zone", StringType()),
    ("dropoff_borough", StringType()),
    ("passenger_count", IntegerType()),
    ("trip_distance", DoubleType()),
    ("total_amount", DoubleType()),
    ("payment_type", IntegerType()),
    ("rate_code_id", IntegerType()),
    ("store_and_fwd_flag", StringType()),
    ("data_source", StringType()),
    ("created_at", TimestampType()),
)

GOLD_COLUMNS = [f.name for f in GOLD.fields]
GOLD_PARTITIONS = ["pickup_year", "pickup_month"]

AGG_KEYS = ["pickup_year", "pickup_month", "pickup_borough", "dropoff_borough"]
AGG_MEASURES = ["total_trips", "total_revenue", "total_trip_distance", "total_passengers"]
AGG = _struct(
    ("pickup_year", IntegerType()),
    ("pickup_month", IntegerType()),
    ("pickup_borough", StringType()),
    ("dropoff_borough", StringType()),
    ("total_trips", LongType()),
    ("total_revenue", DoubleType()),
    ("total_trip_distance", DoubleType()),
    ("total_passengers", LongType()),
)

COMMITS = _struct(
    ("commit_id", LongType()),
    ("operation", StringType()),
    ("committed_at", TimestampType()),
    ("partition", StringType()),
    ("source_commit", LongType()),
    ("rows", LongType()),
    ("high_water_mark", StringType()),
)
# As stored: the first row of a commit also lists the partition folders it wrote.
COMMIT_LOG = StructType([*COMMITS.fields, StructField("written", ArrayType(StringType()), True)])

LANDING = _struct(
    ("status", StringType()),
    ("reason", StringType()),
    ("source_url", StringType()),
    ("s3_uri", StringType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("error", StringType()),
)
