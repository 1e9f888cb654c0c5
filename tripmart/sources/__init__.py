"""Readers: raw landing files (drift-tolerant), the zone CSV, landing bookkeeping,
and trip-shaped views over the driver's tables."""

from .bronze import list_files, raw_glob, read_bronze, schema_drift
from .zones import read_zones_csv, write_zones_csv

__all__ = ["list_files", "raw_glob", "read_bronze", "read_zones_csv", "schema_drift", "write_zones_csv"]
