"""Catalog tables over the folders that the jobs write: SQL by table name, without a copy of the data.

A table of the lake that is written partition by partition (gold, the monthly
aggregate) has one live folder per partition.  The catalog table points each of
its partitions there; after a run only the partitions it rewrote are added or
moved, so publishing costs as many catalog calls as the run touched partitions,
and readers see the old folder or the new one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import AGG, GOLD, GOLD_PARTITIONS
from .pipeline import Lakehouse
from .sql_surface import create_database, create_table
from .versioned import VersionedTable

PUBLISHED = "published_commit"  # table property: the commit that the partitions show


def _spec(path: str) -> str:
    return ", ".join(f"`{k}`='{v}'" for k, v in (part.split("=", 1) for part in path.split("/")))


def _published(spark: SparkSession, name: str) -> int | None:
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return int(properties[PUBLISHED]) if PUBLISHED in properties else None


def publish(spark: SparkSession, name: str, table: VersionedTable) -> int:
    """Point the partitions of catalog table ``name`` at the live folders of ``table``; returns how many were changed.

    The table must hold each partition in one commit (``overwrite`` and
    ``replace_partitions``); appended tables are an error.
    """
    latest = table.latest_commit_id()
    last = _published(spark, name)
    if latest is None or latest == last:
        return 0
    folders = table.partition_folders()
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    changed = 0
    for path, (commit, folder) in sorted(folders.items()):
        if path not in known:
            spark.sql(f"ALTER TABLE {name} ADD PARTITION ({_spec(path)}) LOCATION '{folder}'")
        elif last is None or commit > last:
            spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(path)}) SET LOCATION '{folder}'")
        else:
            continue
        changed += 1
    for path in sorted(known - set(folders)):
        spark.sql(f"ALTER TABLE {name} DROP PARTITION ({_spec(path)})")
        changed += 1
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PUBLISHED}'='{latest}')")
    spark.catalog.refreshTable(name)
    return changed


def publish_lake(spark: SparkSession, lake: Lakehouse, database: str, location: str | None = None) -> dict[str, int]:
    """Create database and tables where needed and publish gold and agg; partitions changed by table."""
    create_database(spark, database, location)
    changed = {}
    for short, table, schema in (("gold", lake.gold, GOLD), ("agg", lake.agg, AGG)):
        if table is None:
            continue
        name = f"`{database}`.`{short}`"
        create_table(spark, name, schema, GOLD_PARTITIONS, location=table.data_root)
        changed[short] = publish(spark, name, table)
    return changed
