"""File-name conventions of the raw landing area."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw file-name pattern and partition folder pattern.
RAW_FILE_PATTERN = "yellow_tripdata_%04d-%02d.parquet"
RAW_FOLDER_PATTERN = "year=%d"


def raw_file_name(year: str | Column, month: str | Column) -> Column:
    """``yellow_tripdata_YYYY-MM.parquet`` for a (year, month) pair of columns."""
    return F.format_string(RAW_FILE_PATTERN, year, month)


def raw_file_key(prefix: str, landed_year: str | Column, year: str | Column, month: str | Column) -> Column:
    """Object key of a landed file: ``<prefix>/year=<landed year>/<file name>``.

    The folder year is the year the file was landed, not the data year.
    """
    folder = F.format_string(RAW_FOLDER_PATTERN, landed_year)
    return F.concat_ws("/", F.lit(prefix.strip("/")), folder, raw_file_name(year, month))
