"""SQL access: temp views over versioned tables and catalog DDL for plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from .pipeline import Lakehouse
from .versioned import VersionedTable


def register_version(table: VersionedTable, name: str, as_of: int | None = None) -> str:
    """Expose a table version to SQL as a temp view (``FOR VERSION AS OF`` stand-in)."""
    table.as_of(as_of).createOrReplaceTempView(name)
    return name


def register_views(lake: Lakehouse, prefix: str = "") -> list[str]:
    """Temp views ``silver``, ``gold``, ``agg`` on the latest versions, for ad-hoc SQL.

    Tables without a location are skipped.
    """
    tables = (("silver", lake.silver), ("gold", lake.gold), ("agg", lake.agg))
    return [register_version(table, f"{prefix}{name}") for name, table in tables if table is not None]


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` with an optional location."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def create_table_sql(
    name: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    compression: str = "snappy",
) -> str:
    """DDL for a parquet catalog table with identity partitions."""
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
    parts = f"\nPARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    where = f"\nLOCATION '{location}'" if location else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING parquet"
        f"\nOPTIONS (compression '{compression}'){parts}{where}"
    )


def create_table(spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str] = (), **kw) -> None:
    spark.sql(create_table_sql(name, schema, partition_by, **kw))
