"""Faults found in review: stale watermarks, unknown versions, wide scopes, partition-dependent sums."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tripmart.functions.measures import stable_sum
from tripmart.operators.merge import any_of, dedupe_source
from tripmart.plans.pipeline import refresh_silver
from tripmart.plans.versioned import VersionedTable

SCHEMA = "k long, day date, v long"


@pytest.mark.parametrize("parts", [1, 7, 501])
def test_sum_does_not_depend_on_partitions(spark, parts):
    rng = random.Random(1)
    values = [round(rng.uniform(0, 1e9), 2) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    assert df.agg(stable_sum("v").alias("s")).first().s == sum(round(v * 100) for v in values) / 100


def test_sum_of_odd_values(spark):
    df = spark.createDataFrame([(1.5,), (None,)], "v double")
    assert df.agg(stable_sum("v").alias("s")).first().s == 1.5
    with_nan = df.union(spark.createDataFrame([(float("nan"),)], "v double"))
    assert str(with_nan.agg(stable_sum("v").alias("s")).first().s) == "nan"
    assert df.limit(0).agg(stable_sum("v").alias("s")).first().s is None


def test_wide_scopes(spark):
    days = [dt.date(2010, 1, 1) + dt.timedelta(days=i) for i in range(5000)]
    df = spark.createDataFrame([(i, d, 0) for i, d in enumerate([*days, dt.date(1999, 1, 1), None])], SCHEMA)
    assert df.where(any_of([{"day": d} for d in days])).count() == 5000
    assert df.where(any_of([{"day": None}])).count() == 1
    by_month = {(d.year, d.month) for d in days}
    keyed = df.select(F.year("day").alias("y"), F.month("day").alias("m"))
    assert keyed.where(any_of([{"y": y, "m": m} for y, m in by_month])).count() == 5000
    assert keyed.where(~any_of([{"y": y, "m": m} for y, m in by_month])).count() == 2


def test_ties_pick_one_row(spark):
    rows = [(1, dt.date(2020, 1, 1), v) for v in range(50)]
    picked = {
        dedupe_source(spark.createDataFrame(rows, SCHEMA).repartition(n), ["k"], ["day"]).first().v for n in (1, 3, 9)
    }
    assert picked == {49}


def test_watermark_after_delete_and_unknown_version(spark, tmp_root):
    rows = [(i, dt.date(2024, m, 15), i) for i, m in enumerate((1, 2, 3))]
    df = spark.createDataFrame(rows, SCHEMA)
    table = VersionedTable(
        spark,
        f"{tmp_root}/t",
        df.schema,
        partition_by=["month"],
        derived={"month": (F.month("day"), IntegerType())},
        watermark_col="day",
    )
    table.overwrite(df)
    assert table.high_water_mark() == dt.date(2024, 3, 15)
    table.delete_where(F.col("day") >= F.lit("2024-03-01"))
    assert table.high_water_mark() == dt.date(2024, 2, 15)
    with pytest.raises(ValueError, match="no version"):
        table.as_of(999)


def test_no_silver(spark):
    with pytest.raises(ValueError, match="silver"):
        refresh_silver(spark, None, None)
