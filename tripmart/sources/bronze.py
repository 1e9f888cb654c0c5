"""Raw ("bronze") trip files: layout, schema drift report, drift-tolerant reads.

Layout: ``<root>/year=<landed year>/yellow_tripdata_<YYYY>-<MM>.parquet``.
The reads glob ``year=*/*.parquet`` so no ``year`` partition column appears,
and run reports kept elsewhere cannot break partition discovery.

Monthly files drift: older ones lack newer fee columns, some store location
ids as int64.  Footers are inspected in executor tasks, the driver learns which
types each column has (not which file has them), and one scan reads every file
in the widest type of each column and casts to the bronze schema; missing
columns become NULL.  Only where a column's types have no common one (say text
and numbers) are the files read group by group.

A ledger of files already read (path, length, modification time) lets an
incremental load open the footers and data of unseen files only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ..schemas import BRONZE
from ..session import scratch_path

RAW_GLOB = "year=*/*.parquet"
FILE_SCHEMA_DDL = "file string, column string, type string, position int"


def raw_glob(root: str, glob: str = RAW_GLOB) -> str:
    return f"{root.rstrip('/')}/{glob}"


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Data files under ``path`` (Spark's own parallel listing; metadata only)."""
    return sorted(spark.read.schema(BRONZE).parquet(path).inputFiles())


def _arrow_uri(uri: str) -> str:
    """Hadoop URI → one Arrow's filesystem layer understands (s3a/s3n are plain S3)."""
    if "://" not in uri:
        return f"file://{uri.removeprefix('file:')}"
    scheme, rest = uri.split("://", 1)
    return f"s3://{rest}" if scheme in ("s3a", "s3n") else uri


def _footer_schemas(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for batch in batches:
        out = []
        for uri in batch["file"]:
            fs, path = pafs.FileSystem.from_uri(_arrow_uri(uri))
            with fs.open_input_file(path) as handle:
                schema = pq.read_schema(handle)
            for pos, field in enumerate(schema):
                out.append((uri, field.name, str(field.type), pos))
        yield pd.DataFrame(out, columns=["file", "column", "type", "position"])


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """``(file, length, modified)`` of every data file under ``path``; no file is opened."""
    meta = spark.read.format("binaryFile").load(path)
    return meta.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _as_files(spark: SparkSession, files: Sequence[str] | DataFrame) -> DataFrame:
    return files.select("file") if isinstance(files, DataFrame) else spark.createDataFrame([(f,) for f in files], "file string")


def file_schemas(spark: SparkSession, files: Sequence[str] | DataFrame) -> DataFrame:
    """``(file, column, type, position)`` for every column of every file (read in tasks)."""
    slices = spark.sparkContext.defaultParallelism * 4
    return _as_files(spark, files).repartition(slices).mapInPandas(_footer_schemas, FILE_SCHEMA_DDL)


# Arrow type names (as ``str(pa.DataType)``) and the Spark types they read as.
_ARROW_TO_SPARK = {
    "int8": ByteType(),
    "int16": ShortType(),
    "int32": IntegerType(),
    "int64": LongType(),
    "float": FloatType(),
    "double": DoubleType(),
    "string": StringType(),
    "large_string": StringType(),
    "bool": BooleanType(),
    "timestamp[us]": TimestampNTZType(),
    "timestamp[ns]": TimestampNTZType(),
    "timestamp[ms]": TimestampNTZType(),
}
_SPARK_TO_ARROW = {
    "IntegerType()": "int32",
    "LongType()": "int64",
    "DoubleType()": "double",
    "StringType()": "string",
    "TimestampNTZType()": "timestamp[us]",
}


def _stored_type(arrow_name: str, fallback):
    """Spark type to read a column stored as ``arrow_name`` (before the cast).

    Zoned parquet timestamps (``timestamp[us, tz=…]``) can only be read as
    TIMESTAMP (with zone); the cast to the NTZ target then keeps the wall time
    in the session zone (UTC in these jobs).
    """
    if arrow_name.startswith("timestamp[") and "tz=" in arrow_name:
        return TimestampType()
    return _ARROW_TO_SPARK.get(arrow_name, fallback)


def expected_types(spark: SparkSession, schema: StructType = BRONZE) -> DataFrame:
    """``(column, expected_type)`` in Arrow type names."""
    rows = [(f.name, _SPARK_TO_ARROW.get(repr(f.dataType), f.dataType.simpleString())) for f in schema.fields]
    return spark.createDataFrame(rows, "column string, expected_type string")


def schema_drift(spark: SparkSession, files: Sequence[str] | DataFrame, schema: StructType = BRONZE) -> DataFrame:
    """Per column: files and folders carrying it, its types, and the drift kind.

    ``missing`` = absent from some files (read as NULL there), ``added`` = not
    in the expected schema (dropped on read), ``retyped`` = some file stores a
    different type (cast on read), ``ok`` otherwise.  Names that differ only in
    case are one column, as they are for Spark's scan.
    """
    files = _as_files(spark, files)
    n_files = files.count()
    found = file_schemas(spark, files).withColumn("name", F.lower("column"))
    per_col = found.groupBy("name").agg(
        F.min("column").alias("stored"),
        F.countDistinct("file").alias("files"),
        F.countDistinct(F.regexp_replace("file", "/[^/]*$", "")).alias("folders"),
        F.array_sort(F.collect_set("type")).alias("types"),
    )
    wanted = expected_types(spark, schema).withColumn("name", F.lower("column"))
    joined = per_col.join(wanted, "name", "full_outer")
    kind = (
        F.when(F.col("expected_type").isNull(), F.lit("added"))
        .when(F.coalesce(F.col("files"), F.lit(0)) < n_files, F.lit("missing"))
        .when(
            (F.size("types") > 1) | (F.col("types")[0] != F.col("expected_type")),
            F.lit("retyped"),
        )
        .otherwise(F.lit("ok"))
    )
    return joined.select(
        F.coalesce("column", "stored").alias("column"),
        F.coalesce(F.col("files"), F.lit(0)).cast("bigint").alias("files"),
        F.lit(n_files).cast("bigint").alias("total_files"),
        F.coalesce(F.col("folders"), F.lit(0)).cast("bigint").alias("folders"),
        F.coalesce(F.col("types"), F.array().cast("array<string>")).alias("types"),
        "expected_type",
        kind.alias("drift"),
    )


_WHOLE_NUMBERS = ["int8", "int16", "int32", "int64"]
_TIMES = ("timestamp[us]", "timestamp[ns]", "timestamp[ms]")


def widest_type(types: set[str]):
    """The Spark type in which files storing a column as any of these Arrow types can all be read, or None."""
    if types <= set(_WHOLE_NUMBERS):
        return _ARROW_TO_SPARK[max(types, key=_WHOLE_NUMBERS.index)]
    if types <= {"float", "double", *_WHOLE_NUMBERS[:3]}:
        return FloatType() if types == {"float"} else DoubleType()
    if types <= {"string", "large_string"}:
        return StringType()
    if types <= set(_TIMES):
        return TimestampNTZType()
    if all(t.startswith("timestamp[") and "tz=" in t for t in types):
        return TimestampType()
    return _ARROW_TO_SPARK.get(next(iter(types))) if len(types) == 1 else None


def _cast_to(schema: StructType, df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _scan(spark: SparkSession, path: str, found: DataFrame, schema: StructType) -> DataFrame | None:
    """One scan of ``path`` with the widest types of ``found(file, column, type)``, not cast yet; None if some clash."""
    # Matched like Spark's scan does, whatever the case; reported under the expected name.
    stored = found.select(F.lower("column").alias("name"), "type").distinct().collect()
    types: dict[str, set[str]] = {}
    for row in stored:
        types.setdefault(row["name"], set()).add(row["type"])
    fields = []
    for f in schema.fields:
        wanted = _SPARK_TO_ARROW.get(repr(f.dataType))
        have = types.get(f.name.lower(), set())
        kind = f.dataType if not have or have == {wanted} else widest_type(have | {wanted}) or widest_type(have)
        if kind is None:
            return None
        fields.append(StructField(f.name, kind, True))
    return spark.read.schema(StructType(fields)).parquet(path)


def read_bronze(spark: SparkSession, path: str, schema: StructType = BRONZE) -> DataFrame:
    """All raw trips under ``path`` (a file, folder or glob) in ``schema``.

    One scan of the path in each column's widest stored type, then a cast.
    Only a column whose types have no common one makes the files be read group
    by group.
    """
    files = file_listing(spark, path)
    found = file_schemas(spark, files)
    scan = _scan(spark, path, found, schema)
    return _cast_to(schema, scan) if scan is not None else _read_by_group(spark, files, found, schema)


def _read_by_group(spark: SparkSession, files: DataFrame, found: DataFrame, schema: StructType) -> DataFrame:
    """Each group of files that store the expected columns alike, scanned on its own, cast and unioned by name."""
    wanted = expected_types(spark, schema).withColumn("name", F.lower("column"))
    odd = (
        found.withColumn("name", F.lower("column"))
        .drop("column")
        .join(wanted, "name")
        .filter(F.col("type") != F.col("expected_type"))
        .groupBy("file")
        .agg(F.array_sort(F.collect_set(F.concat_ws(":", "column", "type"))).alias("sig"))
    )
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in files.join(odd, "file", "left").select("file", "sig").collect():
        groups.setdefault(tuple(row.sig or ()), []).append(row.file)
    parts = []
    for sig, group_files in sorted(groups.items()):
        stored = dict(item.split(":", 1) for item in sig)
        # Read each drifted column in its stored type, then cast to the target.
        fields = [
            StructField(f.name, _stored_type(stored[f.name], f.dataType), True) if f.name in stored else f
            for f in schema.fields
        ]
        parts.append(_cast_to(schema, spark.read.schema(StructType(fields)).parquet(*sorted(group_files))))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


@dataclass
class FileIncrement:
    """Rows of files that no committed increment has read; ``commit`` after the rows are stored."""

    rows: DataFrame
    files: DataFrame  # (file, length, modified)
    footers: DataFrame  # (file, column, type, position) of these files
    ledger: str

    def commit(self) -> None:
        """Enter the files as read.  A crash before it makes the next run read the same files again."""
        self.files.write.mode("append").parquet(self.ledger)


def read_new_files(spark: SparkSession, path: str, ledger: str, schema: StructType = BRONZE) -> FileIncrement | None:
    """The rows of unseen files under ``path``, or None if there are none.

    A file is seen when the ledger (a folder of its own) holds its path, length
    and modification time, so a file that was written anew counts as unseen.
    The listing is anti-joined with the ledger; footers are opened for unseen
    files only; the scan skips files older than the oldest unseen one and is
    semi-joined with the unseen paths, which never come to the driver.
    """
    files = file_listing(spark, path)
    known = spark.read.schema(files.schema).option("ignoreMissingFiles", "true")
    if not _empty_or_missing(spark, ledger):
        files = files.join(known.parquet(ledger), ["file", "length", "modified"], "left_anti")
    files = _staged(files, "unseen-files")
    oldest = files.agg(F.min("modified")).first()[0]
    if oldest is None:
        return None
    footers = _staged(file_schemas(spark, files), "unseen-footers")
    scan = _scan(spark, path, footers, schema)
    if scan is None:
        rows = _read_by_group(spark, files, footers, schema)
    else:
        unseen = files.select(_path_key(F.col("file")).alias("unseen_file"))
        recent = scan.filter(F.col("_metadata.file_modification_time") >= F.lit(oldest))
        recent = recent.withColumn("__file", _path_key(F.col("_metadata.file_path")))
        rows = _cast_to(schema, recent.join(unseen, F.col("__file") == F.col("unseen_file"), "left_semi"))
    return FileIncrement(rows, files, footers, ledger)


def _path_key(path: Column) -> Column:
    """A file's URI with one slash after the scheme, as the readers differ in that."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def _empty_or_missing(spark: SparkSession, folder: str) -> bool:
    try:
        return spark.read.format("binaryFile").load(folder).isEmpty()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return True
        raise


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
