"""Rules F1–F18 on literal rows: each passing and failing case, NULL and NaN."""

import datetime as dt

import pytest

from helpers import T0, trips_df
from tripmart.functions.quality import first_failed_rule
from tripmart.operators.clean import apply_global_rules, apply_rate_rules, clean_trips, reject_reasons

NAN = float("nan")

CASES = [
    # (overrides, kept)
    ({}, True),
    ({"PULocationID": None}, False),
    ({"PULocationID": 0}, False),
    ({"PULocationID": 264}, False),
    ({"PULocationID": 265}, False),
    ({"DOLocationID": None}, False),
    ({"DOLocationID": 0}, False),
    ({"DOLocationID": 265}, False),
    ({"tpep_dropoff_datetime": T0}, False),
    ({"tpep_dropoff_datetime": T0 - dt.timedelta(seconds=1)}, False),
    ({"tpep_pickup_datetime": None}, False),
    ({"tpep_dropoff_datetime": None}, False),
    ({"total_amount": 0.0}, False),
    ({"total_amount": -3.0}, False),
    ({"total_amount": None}, False),
    ({"total_amount": NAN}, True),  # NaN > 0 is true in Spark
    ({"trip_distance": 0.0}, True),
    ({"trip_distance": -0.1}, False),
    ({"trip_distance": None}, False),
    ({"payment_type": 2}, True),
    ({"payment_type": 0}, False),
    ({"payment_type": 3}, False),
    ({"payment_type": None}, False),
    ({"RatecodeID": 6}, False),
    ({"RatecodeID": 99}, False),
    ({"RatecodeID": None}, False),
    # rate 1 boundaries
    ({"fare_amount": 3.0}, True),
    ({"fare_amount": 2.99}, False),
    ({"improvement_surcharge": 0.3}, False),
    ({"mta_tax": 0.0}, True),
    ({"mta_tax": 1.0}, False),
    ({"congestion_surcharge": 0.0}, True),
    ({"congestion_surcharge": 2.75}, False),
    ({"cbd_congestion_fee": 0.0}, True),
    ({"cbd_congestion_fee": 1.5}, False),
    ({"cbd_congestion_fee": None}, False),
    # rate 2
    ({"RatecodeID": 2, "Airport_fee": 0.0, "improvement_surcharge": 0.0}, True),
    ({"RatecodeID": 2, "Airport_fee": -1.0}, False),
    ({"RatecodeID": 2, "improvement_surcharge": 0.3}, False),
    ({"RatecodeID": 2, "cbd_congestion_fee": None}, False),
    # rate 3 ignores fees
    ({"RatecodeID": 3, "cbd_congestion_fee": None, "mta_tax": 7.0}, True),
    ({"RatecodeID": 3, "fare_amount": -1.0}, False),
    ({"RatecodeID": 3, "improvement_surcharge": -0.3}, False),
    # rate 4
    ({"RatecodeID": 4}, True),
    ({"RatecodeID": 4, "mta_tax": 0.0}, False),
    ({"RatecodeID": 4, "cbd_congestion_fee": None}, False),
    # rate 5
    ({"RatecodeID": 5, "mta_tax": 0.0, "fare_amount": 1.0}, True),
    ({"RatecodeID": 5, "improvement_surcharge": 0.0}, False),
    ({"RatecodeID": 5, "congestion_surcharge": None}, False),
]


def test_clean_rules_case_by_case(spark):
    rows = [dict(o, VendorID=i) for i, (o, _) in enumerate(CASES)]
    df = trips_df(spark, rows)
    kept = {r.VendorID for r in clean_trips(df).collect()}
    expected = {i for i, (_, keep) in enumerate(CASES) if keep}
    assert kept == expected


def test_global_and_rate_split_compose(spark):
    rows = [dict(o, VendorID=i) for i, (o, _) in enumerate(CASES)]
    df = trips_df(spark, rows)
    both = {r.VendorID for r in apply_rate_rules(apply_global_rules(df)).collect()}
    assert both == {r.VendorID for r in clean_trips(df).collect()}


def test_reject_reasons_account_for_every_dropped_row(spark):
    rows = [dict(o, VendorID=i) for i, (o, _) in enumerate(CASES)]
    df = trips_df(spark, rows)
    rejected = sum(r.rejected_rows for r in reject_reasons(df).collect())
    assert rejected == sum(1 for _, keep in CASES if not keep)
    labels = {r.VendorID: r.reason for r in df.select("VendorID", first_failed_rule().alias("reason")).collect()}
    assert labels[1] == "F01_pickup_location_present"
    assert labels[3] == "F03_pickup_location_known"
    assert labels[8] == "F07_dropoff_after_pickup"
    assert labels[23] == "F11_rate_code_known"
    assert labels[27] == "F12_rate_1_fees"
    assert labels[0] is None


@pytest.mark.parametrize("excluded,kept", [((264, 265), True), ((100,), False)])
def test_excluded_locations_are_a_parameter(spark, excluded, kept):
    df = trips_df(spark, [{}])
    assert (clean_trips(df, excluded).count() == 1) is kept


def test_simple_rules_reach_the_parquet_scan(spark, tmp_root, capsys):
    path = f"{tmp_root}/bronze"
    trips_df(spark, [{}]).write.parquet(path)
    clean_trips(spark.read.parquet(path)).explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters" in plan and "GreaterThan(total_amount,0.0)" in plan
