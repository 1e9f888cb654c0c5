"""Cleaning rules vs an independent row-by-row model with SQL three-valued logic."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import GOOD, T0, trips_df
from tripmart.functions.quality import first_failed_rule
from tripmart.operators.clean import clean_trips

NAN = float("nan")


def fee(*values):
    return st.sampled_from(list(values) + [None])


ROW = st.fixed_dictionaries(
    {
        "PULocationID": st.sampled_from([None, 0, 1, 264, 265, 100]),
        "DOLocationID": st.sampled_from([None, 0, 2, 264, 200]),
        "minutes": st.sampled_from([None, -5, 0, 20]),
        "total_amount": fee(0.0, -1.0, 12.5, NAN),
        "trip_distance": fee(0.0, -0.5, 3.0, NAN),
        "payment_type": st.sampled_from([None, 0, 1, 2, 3]),
        "RatecodeID": st.sampled_from([None, 1, 2, 3, 4, 5, 6, 99]),
        "fare_amount": fee(-1.0, 0.0, 2.5, 3.0, 10.0),
        "mta_tax": fee(0.0, 0.5, 1.0),
        "improvement_surcharge": fee(-0.3, 0.0, 0.3, 1.0),
        "congestion_surcharge": fee(0.0, 2.5, 2.75),
        "cbd_congestion_fee": fee(0.0, 0.75, 1.5),
        "Airport_fee": fee(-1.0, 0.0, 1.75),
    }
)


def AND(*xs):  # noqa: N802 - SQL semantics
    if any(x is False for x in xs):
        return False
    return None if any(x is None for x in xs) else True


def cmp(a, op, b):
    if a is None or b is None:
        return None
    if isinstance(a, float) and math.isnan(a):  # Spark orders NaN above every number
        return {">": True, ">=": True, "==": False}[op]
    return {">": a > b, ">=": a >= b, "==": a == b}[op]


def isin(a, values):
    if a is None:
        return None
    return a in values


def NOT(x):  # noqa: N802
    return None if x is None else not x


def model_keeps(r):
    pu, do = r["PULocationID"], r["DOLocationID"]
    pickup = T0
    dropoff = None if r["tpep_dropoff_datetime"] is None else r["tpep_dropoff_datetime"]
    global_ok = AND(
        pu is not None, NOT(cmp(pu, "==", 0)), do is not None, NOT(cmp(do, "==", 0)),
        NOT(isin(pu, (264, 265))), NOT(isin(do, (264, 265))),
        pickup is not None, dropoff is not None,
        None if dropoff is None else dropoff > pickup,
        cmp(r["total_amount"], ">", 0), cmp(r["trip_distance"], ">=", 0),
        isin(r["payment_type"], (1, 2)),
    )
    rate = r["RatecodeID"]
    mta, imp, cong, cbd = r["mta_tax"], r["improvement_surcharge"], r["congestion_surcharge"], r["cbd_congestion_fee"]
    if rate == 1:
        branch = AND(cmp(imp, "==", 1.0), isin(mta, (0.0, 0.5)), isin(cong, (0.0, 2.5)),
                     cmp(r["fare_amount"], ">=", 3.0), isin(cbd, (0.0, 0.75)))
    elif rate == 2:
        branch = AND(cmp(r["Airport_fee"], ">=", 0.0), isin(mta, (0.0, 0.5)), isin(imp, (0.0, 1.0)),
                     isin(cong, (0.0, 2.5)), isin(cbd, (0.0, 0.75)))
    elif rate == 3:
        branch = AND(cmp(r["fare_amount"], ">=", 0.0), cmp(imp, ">=", 0.0))
    elif rate == 4:
        branch = AND(cmp(mta, "==", 0.5), cmp(imp, "==", 1.0), isin(cong, (0.0, 2.5)), isin(cbd, (0.0, 0.75)))
    elif rate == 5:
        branch = AND(isin(mta, (0.0, 0.5)), cmp(imp, "==", 1.0), isin(cong, (0.0, 2.5)), isin(cbd, (0.0, 0.75)))
    else:
        branch = False
    return AND(global_ok, isin(rate, (1, 2, 3, 4, 5)), branch) is True


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=40))
def test_clean_matches_model(spark, rows):
    import datetime as dt

    prepared = []
    for i, r in enumerate(rows):
        r = dict(r)
        minutes = r.pop("minutes")
        r["tpep_dropoff_datetime"] = None if minutes is None else T0 + dt.timedelta(minutes=minutes)
        r["VendorID"] = i
        prepared.append(r)
    df = trips_df(spark, prepared)
    kept = {row.VendorID for row in clean_trips(df).collect()}
    assert kept == {r["VendorID"] for r in prepared if model_keeps(dict(GOOD, **r))}
    # every dropped row has a reason, every kept row has none
    reasons = {row.VendorID: row.reason for row in df.select("VendorID", first_failed_rule().alias("reason")).collect()}
    assert {v for v, reason in reasons.items() if reason is None} == kept
