"""Month plan, skip-already-landed and the run report."""

import datetime as dt

from tripmart.schemas import LANDING

from tripmart.sources.landing import (
    landed_months_from_paths,
    landing_report,
    landing_status,
    missing_months,
    month_plan,
    months_of_years,
    previous_month,
    write_landing_report,
)


def test_year_mode_plan_and_statuses(spark, tmp_root):
    years = spark.createDataFrame([(2024,)], "data_year int")
    plan = month_plan(months_of_years(years), dt.date(2024, 10, 1), prefix="raw/taxi/")
    rows = {r.data_month: r for r in plan.collect()}
    assert len(rows) == 12
    assert rows[3].file_name == "yellow_tripdata_2024-03.parquet"
    assert rows[3].object_key == "raw/taxi/year=2024/yellow_tripdata_2024-03.parquet"
    assert [m for m, r in rows.items() if r.pending] == [10, 11, 12]

    files = spark.createDataFrame(
        [("s3://b/raw/taxi/year=2024/yellow_tripdata_2024-01.parquet",), ("s3://b/other.json",)], "f string"
    )
    landed = landed_months_from_paths(files, "f")
    assert [tuple(r) for r in landed.collect()] == [(2024, 1)]
    assert missing_months(plan, landed).count() == 11
    status = landing_status(plan, landed)
    report = {r.status: (r.months, r.run_status) for r in landing_report(status).collect()}
    assert report == {"skipped": (1, "incomplete"), "pending": (3, "incomplete"), "missing": (8, "incomplete")}
    write_landing_report(status, f"{tmp_root}/reports/run-1", store_uri="s3://bucket/")
    report_rows = spark.read.schema(LANDING).json(f"{tmp_root}/reports/run-1").collect()
    assert len(report_rows) == 12
    jan = next(r for r in report_rows if r.month == 1)
    assert (jan.status, jan.reason, jan.s3_uri) == (
        "skipped", "File already exists in S3", "s3://bucket/raw/taxi/year=2024/yellow_tripdata_2024-01.parquet"
    )


def test_monthly_mode_is_previous_month(spark):
    assert [tuple(r) for r in previous_month(spark, dt.date(2025, 1, 6)).collect()] == [(2024, 12)]
