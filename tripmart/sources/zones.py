"""The taxi-zone dimension as a CSV file (header row, explicit schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ZONES


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """``LocationID, Borough, Zone, service_zone`` with the declared types.

    The schema is given, so no inference pass runs over the file.
    """
    return spark.read.option("header", True).schema(ZONES).csv(path)


def write_zones_csv(zones: DataFrame, path: str) -> None:
    """Write a zone frame as one headed CSV file (the dimension is small)."""
    zones.select(*ZONES.fieldNames()).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
