"""A commit history derived from the orders table (one commit per order year).

Used to exercise the snapshot operators on data that grows with the scale
factor: rows of year Y belong to commit ``Y - 1994``; commit 4 is a full
overwrite, every other commit an append.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.versioned import APPEND, COMMIT_COL, OVERWRITE, WHOLE_TABLE
from .tables import table

# Fixed values of the derived history.
FIRST_YEAR_OFFSET = 1994
OVERWRITE_COMMIT = 4

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]


def committed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the ``commit_id`` that would have written them."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    commit = (F.year("o_orderdate") - F.lit(FIRST_YEAR_OFFSET)).cast("bigint")
    return orders.withColumn(COMMIT_COL, commit)


def commit_log(committed: DataFrame) -> DataFrame:
    """``(commit_id, operation, committed_at, partition, rows)`` per commit."""
    op = F.when(F.col(COMMIT_COL) == OVERWRITE_COMMIT, F.lit(OVERWRITE)).otherwise(F.lit(APPEND))
    return committed.groupBy(COMMIT_COL).agg(
        F.max("o_orderdate").alias("committed_at"), F.count(F.lit(1)).alias("rows")
    ).select(
        COMMIT_COL,
        op.alias("operation"),
        "committed_at",
        F.lit(WHOLE_TABLE).alias("partition"),
        F.lit(None).cast("bigint").alias("source_commit"),
        "rows",
        F.col("committed_at").cast("string").alias("high_water_mark"),
    )
