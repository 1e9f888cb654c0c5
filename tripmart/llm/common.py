"""Helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import join_path, scratch_path

# White space that separates words: space and \t \n \v \f \r, as a Java/DuckDB regex class.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark's own reader."""
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage at a table that every executor can read, so a lost
    executor never forces the work above it to run again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text (runs of anything but white space); NULL has none."""
    parts = F.split(F.coalesce(text, F.lit("")), f"{SPACE}+")
    return F.filter(parts, lambda w: w != "")


def zip_shifted(a: Column, b: Column, shift: int, f: Callable[[Column, Column], Column]) -> Column:
    """``f(a[i], b[i + shift])`` for every i that both arrays have."""
    n = F.greatest(F.least(F.size(a), F.size(b) - shift), F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(b, 1 + shift, n), f)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
