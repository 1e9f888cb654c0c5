"""Literal trip rows for unit tests."""

from __future__ import annotations

import datetime as dt

from tripmart.schemas import SILVER

T0 = dt.datetime(2024, 1, 15, 8, 0, 0)

# A trip that passes every rule (rate code 1).
GOOD = dict(
    VendorID=1,
    tpep_pickup_datetime=T0,
    tpep_dropoff_datetime=T0 + dt.timedelta(minutes=20),
    passenger_count=1,
    trip_distance=3.2,
    RatecodeID=1,
    store_and_fwd_flag="N",
    PULocationID=100,
    DOLocationID=200,
    payment_type=1,
    fare_amount=15.0,
    extra=0.0,
    mta_tax=0.5,
    tip_amount=0.0,
    tolls_amount=0.0,
    improvement_surcharge=1.0,
    total_amount=19.5,
    congestion_surcharge=2.5,
    Airport_fee=0.0,
    cbd_congestion_fee=0.75,
)


def trip(**overrides):
    row = dict(GOOD)
    row.update(overrides)
    return tuple(row[f.name] for f in SILVER.fields)


def trips_df(spark, rows):
    return spark.createDataFrame([trip(**r) if isinstance(r, dict) else r for r in rows], SILVER)
