"""Casts that sort rows out instead of ending the job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECTED = "rejected_columns"


def _failed(df: DataFrame, targets: dict[str, str]) -> dict[str, Column]:
    """Column → whether its value is there but has no value of the wanted type."""
    return {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in targets.items()}


def split_casts(df: DataFrame, targets: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` for casts ``{column: type}``.

    Accepted rows have every column cast; rejected ones keep their values as
    they came, with ``rejected_columns`` naming the columns that overflow or do
    not parse.  NULLs are accepted.  A strict cast would end the job at the
    first such row.  Both frames are filters of one scan, without a shuffle.
    """
    failed = _failed(df, targets)
    names = F.filter(F.array(*[F.when(bad, F.lit(c)) for c, bad in failed.items()]), lambda x: x.isNotNull())
    any_failed = reduce(lambda a, b: a | b, failed.values(), F.lit(False))
    accepted = df.filter(~any_failed).select(
        *[F.col(c).try_cast(targets[c]).alias(c) if c in targets else F.col(c) for c in df.columns]
    )
    return accepted, df.filter(any_failed).withColumn(REJECTED, names)


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows by the columns at fault: ``(rejected_columns, rejected_rows)``, names comma-joined."""
    key = F.array_join(REJECTED, ",").alias(REJECTED)
    return rejected.groupBy(key).agg(F.count(F.lit(1)).alias("rejected_rows"))
