"""Calendar parts of a timestamp, as used by the gold table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_parts(ts: str | Column, prefix: str = "pickup") -> list[Column]:
    """date, year, month, day, full weekday name and hour of ``ts``.

    The weekday uses the ``EEEE`` pattern (``Monday``); ``dayname`` would give
    the short form.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return [
        F.to_date(c).alias(f"{prefix}_date"),
        F.year(c).cast("int").alias(f"{prefix}_year"),
        F.month(c).cast("int").alias(f"{prefix}_month"),
        F.dayofmonth(c).cast("int").alias(f"{prefix}_day"),
        F.date_format(c, "EEEE").alias(f"{prefix}_day_of_week"),
        F.hour(c).cast("int").alias(f"{prefix}_hour"),
    ]
