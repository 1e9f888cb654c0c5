"""High-water-mark incremental reads (the bronze → silver switch)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import trip_id
from ..functions.quality import after_watermark


def scalar(df: DataFrame):
    """The single value of a one-row, one-column aggregate (None when NULL).

    Only used for scalar aggregates (a watermark, a count): one row crosses to
    the driver, which then becomes a literal that the next scan can push down.
    """
    row = df.first()
    return None if row is None else row[0]


def read_after_watermark(bronze: DataFrame, column: str, watermark) -> DataFrame:
    """rows strictly newer than ``watermark``; all rows when it is None."""
    if watermark is None:
        return bronze
    return bronze.filter(after_watermark(column, watermark))


def late_rows(bronze: DataFrame, silver: DataFrame, column: str, watermark: dt.datetime, days: int) -> DataFrame:
    """Rows of the last ``days`` days up to ``watermark`` whose trip key silver does not hold.

    Both sides are cut to that window by a pushed-down range, so the anti join
    on the key shuffles no more than the window, however long silver is.  Rows
    older than the window stay out; several new rows of one key come in
    together, as they do above the watermark.
    """
    start = F.lit(watermark - dt.timedelta(days=days)).cast(dict(bronze.dtypes)[column])
    inside = (F.col(column) > start) & (F.col(column) <= F.lit(watermark))
    known = silver.filter(inside).select(trip_id().alias("known_key"))
    return bronze.filter(inside).join(known, trip_id() == F.col("known_key"), "left_anti")
