"""Whether written files really are sorted (the physical order inside each file)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def order_violations(stored: DataFrame, column: str) -> DataFrame:
    """One row ``(rows, violations)``: rows of a parquet scan that are smaller than the row before them in their file.

    ``stored`` must be a scan (it needs the file and row number that the reader
    knows).  NULLs sort first, so a NULL after a value is a violation.  Each
    file is one window; files are bounded by the writer, and equal file names
    never meet in different folders because the path is the key.
    """
    rows = stored.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"), F.col(column).alias("value")
    )
    before = Window.partitionBy("file").orderBy("place")
    rows = rows.withColumns({"first": F.row_number().over(before) == 1, "last": F.lag("value").over(before)})
    falls = F.coalesce(F.col("value") < F.col("last"), F.col("value").isNull() & F.col("last").isNotNull())
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("first") & falls).alias("violations"))
