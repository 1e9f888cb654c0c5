"""Landing of monthly raw files: which months to fetch, which exist, run report.

The download itself (HTTP → object store) is a single-machine tool and is not
part of this package; what is kept is its planning and bookkeeping, expressed
as DataFrames so that the plan, the skip check and the report are joins and
aggregates over file listings.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import raw_file_key, raw_file_name
from .bronze import list_files

# Statuses of a planned month, and the reason text per status.
SKIPPED = "skipped"  # file already landed
PENDING = "pending"  # month not published yet at the run date
MISSING = "missing"  # due but not landed: to download (or failed)
SUCCESS = "success"  # landed by this run
FAILED = "failed"  # tried by this run, with an error
LOST = "lost"  # there before the run, gone after it
UNPLANNED = "unplanned"  # landed, but not in the plan
REASONS = {
    SKIPPED: "File already exists in S3",
    PENDING: "Month not published yet",
    MISSING: "File not landed",
    SUCCESS: "File landed",
    FAILED: "Download failed",
    LOST: "File no longer there",
    UNPLANNED: "Month not in the plan",
}

# Year and month as written in a raw file name: yellow_tripdata_YYYY-MM.parquet
# (either the file itself or a folder of that name holding part files).
FILE_MONTH_PATTERN = r"yellow_tripdata_(\d{4})-(\d{2})\.parquet(/|$)"


def months_of_years(years: DataFrame, year_col: str = "data_year") -> DataFrame:
    """Year mode: all twelve months of every year in ``years``."""
    return years.select(
        F.col(year_col).cast("int").alias("data_year"),
        F.explode(F.sequence(F.lit(1), F.lit(12))).alias("data_month"),
    )


def previous_month(spark: SparkSession, run_date: dt.date) -> DataFrame:
    """Monthly mode: the single month before ``run_date``."""
    first = run_date.replace(day=1)
    prev = first - dt.timedelta(days=1)
    return spark.createDataFrame([(prev.year, prev.month)], "data_year int, data_month int")


def month_plan(months: DataFrame, run_date: dt.date, prefix: str = "raw/taxi") -> DataFrame:
    """File name, object key and due/pending state of each planned month.

    A month is ``pending`` when it has not ended before ``run_date``'s month
    (its file cannot be published yet); files land under the run date's year.
    """
    run_month = run_date.year * 12 + run_date.month
    month_index = F.col("data_year") * 12 + F.col("data_month")
    return months.select(
        "data_year",
        "data_month",
        raw_file_name("data_year", "data_month").alias("file_name"),
        raw_file_key(prefix, F.lit(run_date.year), "data_year", "data_month").alias("object_key"),
        F.lit(run_date.year).alias("landed_year"),
        (month_index >= F.lit(run_month)).alias("pending"),
    )


def landed_months(spark: SparkSession, path: str) -> DataFrame:
    """(data_year, data_month) of every raw file under ``path`` (from file names)."""
    files = spark.createDataFrame([(f,) for f in list_files(spark, path)], "file string")
    return landed_months_from_paths(files, "file")


def landed_months_from_paths(files: DataFrame, path_col: str) -> DataFrame:
    year = F.regexp_extract(F.col(path_col), FILE_MONTH_PATTERN, 1)
    month = F.regexp_extract(F.col(path_col), FILE_MONTH_PATTERN, 2)
    return (
        files.filter(F.col(path_col).rlike(FILE_MONTH_PATTERN))
        .select(year.cast("int").alias("data_year"), month.cast("int").alias("data_month"))
        .distinct()
    )


def missing_months(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Planned months without a landed file (left anti join on year, month)."""
    return plan.join(landed, ["data_year", "data_month"], "left_anti")


def landing_status(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Each planned month with its status.

    ``landed`` is small (one row per month on disk); the left join lets
    Catalyst/AQE pick the strategy from its real size.
    """
    marked = landed.select("data_year", "data_month", F.lit(True).alias("landed"))
    joined = plan.join(marked, ["data_year", "data_month"], "left")
    status = (
        F.when(F.col("landed").isNotNull(), F.lit(SKIPPED))
        .when(F.col("pending"), F.lit(PENDING))
        .otherwise(F.lit(MISSING))
    )
    return joined.select("data_year", "data_month", "file_name", "object_key", status.alias("status"))


def landing_outcomes(plan: DataFrame, before: DataFrame, after: DataFrame, errors: DataFrame, source_root: str = "") -> DataFrame:
    """What a run made of every month: one row per month that is planned or listed.

    ``before`` and ``after`` list the landed months (data_year, data_month)
    around the run, ``errors`` (data_year, data_month, error) the downloads
    that ended in an error.  The listings meet in a full outer join, and again
    with the plan, so months that vanished or were never planned show up too.
    A month that landed after an error is a success; its error is kept.
    """
    keys = ["data_year", "data_month"]
    listed = (
        before.select(*keys, F.lit(True).alias("was")).distinct()
        .join(after.select(*keys, F.lit(True).alias("is")).distinct(), keys, "full_outer")
    )
    last_error = errors.groupBy(*keys).agg(F.max("error").alias("error"))
    joined = plan.withColumn("planned", F.lit(True)).join(listed, keys, "full_outer").join(last_error, keys, "left")
    was, now = F.col("was").isNotNull(), F.col("is").isNotNull()
    status = (
        F.when(was & ~now, F.lit(LOST))
        .when(F.col("planned").isNull(), F.lit(UNPLANNED))
        .when(was, F.lit(SKIPPED))
        .when(now, F.lit(SUCCESS))
        .when(F.col("error").isNotNull(), F.lit(FAILED))
        .when(F.col("pending"), F.lit(PENDING))
        .otherwise(F.lit(MISSING))
    )
    name = raw_file_name("data_year", "data_month")
    return joined.select(
        *keys, name.alias("file_name"), "object_key", status.alias("status"), "error",
        F.concat(F.lit(source_root), name).alias("source_url"),
    )


def outcome_report(outcomes: DataFrame) -> DataFrame:
    """Months per status and the run's: ``failed`` if a download failed or a file was lost, ``incomplete`` if a due
    month is missing, else ``completed``."""
    counts = outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("months"))
    bad = counts.filter(F.col("status").isin(FAILED, LOST)).agg(F.count(F.lit(1))).scalar()
    missing = counts.filter(F.col("status") == MISSING).agg(F.count(F.lit(1))).scalar()
    run = F.when(bad > 0, F.lit("failed")).when(missing > 0, F.lit("incomplete")).otherwise(F.lit("completed"))
    return counts.select("status", "months", run.alias("run_status"))


def landing_report(status: DataFrame) -> DataFrame:
    """Months per status, plus the derived run status (``completed`` only if none is missing)."""
    counts = status.groupBy("status").agg(F.count(F.lit(1)).alias("months"))
    # "Is any due month missing?" as a scalar subquery over the (≤ 3-row) counts.
    missing = counts.filter(F.col("status") == MISSING).agg(F.count(F.lit(1))).scalar()
    run_status = F.when(missing > 0, F.lit("incomplete")).otherwise(F.lit("completed"))
    return counts.select("status", "months", run_status.alias("run_status"))


def landing_records(status: DataFrame, store_uri: str | None = None) -> DataFrame:
    """Per-month records in the landing-result shape (``schemas.LANDING``).

    ``s3_uri`` is the object key under ``store_uri`` (e.g. ``s3://bucket``);
    ``source_url`` and ``error`` are those of ``landing_outcomes``, NULL for a
    status without them.
    """
    reason = F.create_map(*[x for k, v in REASONS.items() for x in (F.lit(k), F.lit(v))])[F.col("status")]
    uri = F.col("object_key") if not store_uri else F.concat_ws("/", F.lit(store_uri.rstrip("/")), "object_key")
    return status.select(
        F.col("status"),
        reason.alias("reason"),
        _or_null(status, "source_url"),
        uri.alias("s3_uri"),
        F.col("data_year").cast("int").alias("year"),
        F.col("data_month").cast("int").alias("month"),
        _or_null(status, "error"),
    )


def _or_null(df: DataFrame, column: str) -> Column:
    return (F.col(column) if column in df.columns else F.lit(None)).cast("string").alias(column)


def write_landing_report(status: DataFrame, path: str, store_uri: str | None = None) -> None:
    """Persist one run's per-month records as JSON lines.

    Keep ``path`` outside the raw data root: a ``reports/year=…`` folder inside
    it would clash with the data layout during partition discovery.
    """
    landing_records(status, store_uri).coalesce(1).write.mode("overwrite").json(path)
