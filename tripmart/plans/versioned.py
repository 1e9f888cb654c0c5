"""Versioned tables on plain parquet: commits, as-of reads, incremental reads.

No table format jar (Iceberg/Delta) is assumed, so snapshots are a user-level
convention:

* data lives under ``<root>/data/commit_id=<N>/<table partitions>/``;
* ``<root>/_commits/commit-<N>/`` holds one tiny parquet file per commit with rows
  ``(commit_id, operation, committed_at, partition)``; ``partition`` is ``*``
  for the whole table or one ``col=value/...`` path per rewritten partition.

Operations follow snapshot vocabulary: ``append`` adds rows; ``overwrite`` with
``*`` replaces the table, with partition paths it replaces just those
partitions (that is how an upsert commits).  Data is written before its commit
row, so a reader never sees half a commit, and a crashed writer's leftovers are
ignored (no commit row) and cleared by the next write of that commit id.

Reading a version means reading its live folders: the commit log (a few rows
per commit, with the partitions that the commit wrote) is read on the driver,
and only the folders whose rows still count are handed to the reader, whole
commits where nothing in them was rewritten since.  There is no predicate, so a
plan does not grow with the log.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    FractionalType,
    IntegralType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ..operators.merge import any_of
from ..schemas import COMMIT_LOG, COMMITS

COMMIT_COL = "commit_id"
WHOLE_TABLE = "*"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name of a NULL
APPEND, OVERWRITE, DELETE, REPLACE = "append", "overwrite", "delete", "replace"


@dataclass(frozen=True)
class Commit:
    commit_id: int
    operation: str
    committed_at: dt.datetime
    partitions: tuple[str, ...]  # ("*",) or partition paths
    source_commit: int | None = None  # upstream commit this one was computed from
    rows: int | None = None  # rows written
    high_water_mark: str | None = None  # max of the table's watermark column in this commit
    written: tuple[str, ...] | None = None  # partition folders it wrote; None if the log does not tell


def parse_literal(text: str, dtype: DataType):
    """Python value of Spark's string form of a scalar (as written by ``cast(string)``)."""
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return dt.datetime.fromisoformat(text)
    if isinstance(dtype, DateType):
        return dt.date.fromisoformat(text)
    if isinstance(dtype, IntegralType):
        return int(text)
    if isinstance(dtype, FractionalType):
        return float(text)
    return text


def partition_path(values: dict[str, object]) -> str:
    """Folder of a partition below its commit (numbers, dates and plain names; no characters that Spark escapes)."""
    return "/".join(f"{k}={NULL_PARTITION if v is None else v}" for k, v in values.items())


def _path_column(names: Sequence[str]) -> Column:
    """``partition_path`` of a row's partition columns."""
    value = [F.coalesce(F.col(n).cast("string"), F.lit(NULL_PARTITION)) for n in names]
    return F.concat_ws("/", *[F.concat(F.lit(f"{n}="), v) for n, v in zip(names, value, strict=True)])


def _parse_path(path: str) -> dict[str, str]:
    return dict(part.split("=", 1) for part in path.split("/") if part)


def live_commits(commits: Sequence[Commit], as_of: int) -> tuple[list[Commit], dict[str, int]]:
    """Commits up to ``as_of`` since the last whole overwrite, and who last rewrote each partition since.

    A commit's rows in a partition are live unless a later commit rewrote it.
    A delete commit holds the rows that survive in the partitions it rewrote.
    """
    live: list[Commit] = []
    rewritten: dict[str, int] = {}
    for c in sorted(commits, key=lambda c: c.commit_id):
        if c.commit_id > as_of:
            break
        if c.operation != APPEND:
            if WHOLE_TABLE in c.partitions:
                live, rewritten = [], {}
            else:
                rewritten.update(dict.fromkeys(c.partitions, c.commit_id))
        live.append(c)
    return live, rewritten


def live_files(commits: Sequence[Commit], as_of: int) -> list[tuple[int, frozenset[str] | None]]:
    """Per commit ≤ ``as_of``: (commit_id, partitions superseded later) of what is live.

    ``None`` as the second element means "every partition of that commit is
    still live"; a set lists partitions rewritten by a later overwrite.
    """
    live, rewritten = live_commits(commits, as_of)
    dead = {c.commit_id: frozenset(p for p, by in rewritten.items() if by > c.commit_id) for c in live}
    return [(c.commit_id, dead[c.commit_id] or None) for c in live]


def commits_from_frame(log: DataFrame) -> list[Commit]:
    """Collect a commit log ``(commit_id, operation, committed_at, partition)``.

    Metadata only: one row per commit and rewritten partition.
    """
    if "written" not in log.columns:  # a log without folder lists
        log = log.withColumn("written", F.lit(None).cast("array<string>"))
    grouped = (
        log.groupBy(COMMIT_COL)
        .agg(
            F.first("operation").alias("operation"),
            F.max("committed_at").alias("committed_at"),
            F.collect_set("partition").alias("partitions"),
            F.max("source_commit").alias("source_commit"),
            F.max("rows").alias("rows"),
            F.max("high_water_mark").alias("high_water_mark"),
            F.first("written", ignorenulls=True).alias("written"),
        )
        .orderBy(COMMIT_COL)
        .collect()
    )
    return [
        Commit(
            int(r[COMMIT_COL]),
            r.operation,
            r.committed_at,
            tuple(sorted(r.partitions)),
            None if r.source_commit is None else int(r.source_commit),
            None if r.rows is None else int(r.rows),
            r.high_water_mark,
            None if r.written is None else tuple(sorted(r.written)),
        )
        for r in grouped
    ]


def partition_filter(partitions: Iterable[dict[str, object]], schema: StructType) -> Column:
    """Predicate matching any of the given partition value maps, as flat ``IN`` lists of typed literals."""

    def typed(name: str, value: object) -> object:
        if value == NULL_PARTITION:
            return None
        known = isinstance(value, str) and name in schema.fieldNames()
        return parse_literal(value, schema[name].dataType) if known else value

    return any_of([{k: typed(k, v) for k, v in p.items()} for p in partitions])


def live_predicate(commits: Sequence[Commit], as_of: int) -> Column:
    """Predicate over ``commit_id`` selecting rows live at ``as_of``, for logs of whole-table operations."""
    live, rewritten = live_commits(commits, as_of)
    if rewritten:
        raise ValueError("partitions were rewritten: read their folders instead")
    return F.col(COMMIT_COL).isin([c.commit_id for c in live]) if live else F.lit(False)


def appended_predicate(commits: Sequence[Commit], start_exclusive: int, end_inclusive: int) -> Column:
    """Predicate selecting rows of ``append`` commits with start < commit_id ≤ end."""
    ids = [
        c.commit_id
        for c in commits
        if c.operation == APPEND and start_exclusive < c.commit_id <= end_inclusive
    ]
    return F.col(COMMIT_COL).isin(ids) if ids else F.lit(False)


def latest_commits(log: DataFrame, n: int = 2) -> DataFrame:
    """``snapshot_id, operation, committed_at`` of the newest ``n`` commits.

    ``orderBy(...).limit(n)`` plans a TakeOrderedAndProject (per-task top-n).
    """
    return (
        log.groupBy(COMMIT_COL)
        .agg(F.first("operation").alias("operation"), F.max("committed_at").alias("committed_at"))
        .orderBy(F.col("committed_at").desc(), F.col(COMMIT_COL).desc())
        .limit(n)
        .select(F.col(COMMIT_COL).alias("snapshot_id"), "operation", "committed_at")
    )


class VersionedTable:
    """A parquet table with a commit log; see the module docstring."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        derived: dict[str, tuple[Column, DataType]] | None = None,
        watermark_col: str | None = None,
        compression: str = "snappy",
    ):
        """``derived`` adds hidden partition columns computed on write (e.g. the
        pickup day of a timestamp); they are partition folders, not returned
        by reads."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.partition_by = list(partition_by)
        self.sort_by = list(sort_by)
        self.derived = dict(derived or {})
        self.watermark_col = watermark_col
        self.compression = compression
        self._commits: list[Commit] | None = None

    # -- paths ---------------------------------------------------------------
    @property
    def data_root(self) -> str:
        return f"{self.root}/data"

    @property
    def log_root(self) -> str:
        return f"{self.root}/_commits"

    # -- commit log ----------------------------------------------------------
    def _read_log(self) -> DataFrame | None:
        """The commit log files, or None before the first commit wrote any."""
        try:
            return self.spark.read.schema(COMMIT_LOG).option("recursiveFileLookup", "true").parquet(self.log_root)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc):
                return None
            raise

    def commits_frame(self) -> DataFrame:
        """The commit log as a DataFrame (typed and empty before the first commit)."""
        log = self._read_log()
        return log if log is not None else self.spark.createDataFrame([], COMMIT_LOG)

    def commits(self) -> list[Commit]:
        """Commit log on the driver, cached until this object writes a commit.

        One writer per table is assumed (as for the scheduled jobs); create a
        new ``VersionedTable`` to see commits made by another process.
        """
        if self._commits is None:
            log = self._read_log()
            self._commits = [] if log is None else commits_from_frame(log)
        return self._commits

    def latest_commit_id(self) -> int | None:
        ids = [c.commit_id for c in self.commits()]
        return max(ids) if ids else None

    def high_water_mark(self):
        """Max watermark value over the live commits, from the log (no data scan).

        Falls back to ``MAX(column)`` over the table when a live commit was partly
        superseded or predates watermark bookkeeping.  Returns a value of the column's type, or None.
        """
        if not self.watermark_col:
            raise ValueError("table has no watermark column")
        commits = self.commits()
        if not commits:
            return None
        live, rewritten = live_commits(commits, commits[-1].commit_id)
        newest = max(rewritten.values(), default=0)
        if any(c.commit_id < newest for c in live):
            # The row that set a commit's mark may lie in a partition that was rewritten since.
            return self.as_of().agg(F.max(self.watermark_col)).first()[0]
        marks = [c.high_water_mark for c in live if (c.rows or 0) > 0]
        if None in marks:
            return self.as_of().agg(F.max(self.watermark_col)).first()[0]
        if not marks:
            return None
        dtype = self.schema[self.watermark_col].dataType
        return max(parse_literal(m, dtype) for m in marks)

    def row_count(self, commit_id: int | None = None) -> int:
        """Rows in a version: summed from the log when no live commit was partly
        superseded (append/overwrite histories), else counted."""
        commits = self.commits()
        if not commits:
            return 0
        as_of = commit_id if commit_id is not None else commits[-1].commit_id
        live, rewritten = live_commits(commits, as_of)
        newest = max(rewritten.values(), default=0)
        if all(c.commit_id >= newest and c.rows is not None for c in live):
            return sum(c.rows for c in live)
        return self.as_of(as_of).count()

    def last_source_commit(self) -> int | None:
        """Newest upstream commit this table has consumed (per-consumer progress)."""
        done = [c.source_commit for c in self.commits() if c.source_commit is not None]
        return max(done) if done else None

    def _write_commit(
        self, df: DataFrame, operation: str, partitions: Iterable[str], source_commit: int | None = None
    ) -> int:
        commit_id = (self.latest_commit_id() or 0) + 1
        target = f"{self.data_root}/{COMMIT_COL}={commit_id}"
        out = df.select(
            *self.schema.fieldNames(), *[expr.alias(name) for name, (expr, _) in self.derived.items()]
        )
        # Row count and watermark are gathered by the write job itself.
        stats = [F.count(F.lit(1)).alias("rows")]
        if self.watermark_col:
            stats.append(F.max(self.watermark_col).cast("string").alias("hwm"))
        observation = Observation(f"commit_{commit_id}_{uuid.uuid4().hex}")
        if self.partition_by:
            # Rebalance on the partition columns: each task writes few table
            # partitions (no small-file explosion) and AQE splits any hot
            # partition across tasks instead of funnelling it into one.
            out = out.hint("rebalance", *self.partition_by)
        if self.partition_by or self.sort_by:
            out = out.sortWithinPartitions(*self.partition_by, *self.sort_by)
        # Observed in the write's own stage: a stage below a shuffle that ran again would count twice.
        out = out.observe(observation, *stats)
        writer = out.write.mode("overwrite").option("compression", self.compression)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(target)
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        try:
            metrics = observation.get
        except Exception:  # noqa: BLE001 - an empty write reports no metrics
            written = self.spark.read.schema(self.stored_schema).parquet(target)
            metrics = written.agg(*stats).first().asDict()
        n_rows, hwm = int(metrics.get("rows") or 0), metrics.get("hwm")
        scope = sorted(set(partitions))
        written = self._written_folders(commit_id) if self.partition_by and n_rows else None
        # The folder list stands in the commit's first row only.
        rows = [(commit_id, operation, now, p, source_commit, n_rows, hwm, None if i else written) for i, p in enumerate(scope)]
        (
            self.spark.createDataFrame(rows, COMMIT_LOG)
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(f"{self.log_root}/commit-{commit_id:010d}")
        )
        if self._commits is not None:  # we are the only writer: extend the cached log
            self._commits = self._commits + [
                Commit(commit_id, operation, now, tuple(scope), source_commit, n_rows, hwm, written and tuple(written))
            ]
        return commit_id

    # -- writes --------------------------------------------------------------
    def append(self, df: DataFrame, source_commit: int | None = None) -> int:
        return self._write_commit(df, APPEND, [WHOLE_TABLE], source_commit)

    def overwrite(self, df: DataFrame, source_commit: int | None = None) -> int:
        return self._write_commit(df, OVERWRITE, [WHOLE_TABLE], source_commit)

    def replace_partitions(
        self, df: DataFrame, partitions: Iterable[dict[str, object]], source_commit: int | None = None
    ) -> int:
        """Replace exactly the listed partitions with ``df`` (an upsert's commit)."""
        paths = [partition_path(p) for p in partitions]
        if not paths:
            raise ValueError("replace_partitions needs at least one partition")
        return self._write_commit(df, OVERWRITE, paths, source_commit)

    def delete_where(self, condition: Column, source_commit: int | None = None) -> int | None:
        """Delete the rows matching ``condition`` (a ``delete`` commit).

        Only partitions that hold a matching row are rewritten (their other
        rows are kept); the partition list comes from one aggregate pass and
        is bounded like a MERGE scope.  Returns None when nothing matches.
        """
        current = self.as_of()
        doomed = F.coalesce(condition, F.lit(False))
        if not self.partition_by:
            if current.filter(doomed).isEmpty():
                return None
            return self._write_commit(current.filter(~doomed), DELETE, [WHOLE_TABLE], source_commit)
        exprs = {name: self.derived[name][0] if name in self.derived else F.col(name) for name in self.partition_by}
        keyed = current.select("*", *[e.alias(f"__p_{n}") for n, e in exprs.items()])
        rows = (
            keyed.filter(doomed)
            .select(*[F.col(f"__p_{n}").alias(n) for n in exprs])
            .distinct()
            .collect()
        )
        if not rows:
            return None
        touched = [r.asDict() for r in rows]
        in_scope = any_of([{f"__p_{k}": v for k, v in t.items()} for t in touched])
        keep = keyed.filter(in_scope & ~doomed).select(*self.schema.fieldNames())
        return self._write_commit(keep, DELETE, [partition_path(t) for t in touched], source_commit)

    def compact(self) -> int | None:
        """Rewrite the current version as one ``replace`` commit (same rows, fewer files).

        Reads then list a single commit folder instead of every append since
        the last overwrite.  Content is unchanged, so consumers tracking their
        progress skip it; the consumed-upstream marker is carried over.
        Returns None when there is nothing to merge (one live commit or none).
        """
        commits = self.commits()
        if not commits or len(live_commits(commits, commits[-1].commit_id)[0]) <= 1:
            return None
        return self._write_commit(self.as_of(), REPLACE, [WHOLE_TABLE], self.last_source_commit())

    def partitions_since(self, start_exclusive: int | None) -> list[dict[str, str]] | None:
        """Partitions whose content changed after ``start_exclusive`` (None = whole table).

        Compactions (``replace``) keep the content and are skipped.
        """
        touched: set[str] = set()
        for c in self.commits():
            if start_exclusive is not None and c.commit_id <= start_exclusive:
                continue
            if c.operation == REPLACE:
                continue
            if WHOLE_TABLE in c.partitions:
                return None
            touched.update(c.partitions)
        return [_parse_path(p) for p in sorted(touched)]

    # -- reads ---------------------------------------------------------------
    @property
    def stored_schema(self) -> StructType:
        """Columns as stored: the table schema plus derived partition columns."""
        extra = [StructField(name, dtype, True) for name, (_, dtype) in self.derived.items()]
        return StructType(list(self.schema.fields) + extra)

    def _scan(self, folders: Sequence[str]) -> DataFrame:
        """Scan of the given folders below the data root only: old versions are not even listed."""
        fields = list(self.stored_schema.fields) + [StructField(COMMIT_COL, COMMITS[COMMIT_COL].dataType, True)]
        paths = [f"{self.data_root}/{f}" for f in sorted(set(folders))]
        return self.spark.read.schema(StructType(fields)).option("basePath", self.data_root).parquet(*paths)

    def _written_folders(self, commit_id: int) -> list[str]:
        """Partition folders of a commit, from a scan that reads no data column."""
        rows = self._scan([f"{COMMIT_COL}={commit_id}"]).select(_path_column(self.partition_by).alias("p")).distinct()
        return sorted(r.p for r in rows.collect())

    def _live_folders(self, as_of: int) -> list[str]:
        """Folders below the data root whose rows are live: whole commits, or single partitions where some were rewritten."""
        live, rewritten = live_commits(self.commits(), as_of)
        newest = max(rewritten.values(), default=0)
        folders = []
        for c in live:
            root = f"{COMMIT_COL}={c.commit_id}"
            if c.rows == 0:
                continue
            if c.commit_id >= newest:
                folders.append(root)
                continue
            written = c.written if c.written is not None else self._written_folders(c.commit_id)
            kept = [p for p in written if rewritten.get(p, 0) <= c.commit_id]
            folders += [root] if len(kept) == len(written) else [f"{root}/{p}" for p in kept]
        return folders

    def partition_folders(self, commit_id: int | None = None) -> dict[str, tuple[int, str]]:
        """Partition path → (commit, folder) of a version in which each partition lies in one commit."""
        live, rewritten = live_commits(self.commits(), commit_id or self.latest_commit_id() or 0)
        found: dict[str, tuple[int, str]] = {}
        for c in live:
            if c.rows == 0:
                continue
            written = c.written if c.written is not None else self._written_folders(c.commit_id)
            for p in written:
                if rewritten.get(p, 0) > c.commit_id:
                    continue
                if p in found:
                    raise ValueError(f"partition {p} lies in commits {found[p][0]} and {c.commit_id}")
                found[p] = c.commit_id, f"{self.data_root}/{COMMIT_COL}={c.commit_id}/{p}"
        return found

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _empty_with(self, with_commit_id: bool) -> DataFrame:
        empty = self._empty()
        return empty.withColumn(COMMIT_COL, F.lit(None).cast("bigint")) if with_commit_id else empty

    def as_of(self, commit_id: int | None = None, with_commit_id: bool = False) -> DataFrame:
        """The table as of ``commit_id`` (latest when None); typed empty if none.

        ``with_commit_id`` keeps the commit that wrote each row.  A version
        that was never committed is an error.
        """
        commits = self.commits()
        if commit_id is not None and all(c.commit_id != commit_id for c in commits):
            raise ValueError(f"no version {commit_id} of this table")
        cols = self.schema.fieldNames() + ([COMMIT_COL] if with_commit_id else [])
        if not commits:
            return self._empty_with(with_commit_id)
        as_of = commit_id if commit_id is not None else commits[-1].commit_id
        folders = self._live_folders(as_of)
        if not folders:
            return self._empty_with(with_commit_id)  # e.g. as of a delete-all commit
        return self._scan(folders).select(*cols)

    def appended_between(self, start_exclusive: int, end_inclusive: int) -> DataFrame:
        """Rows added by ``append`` commits with start < commit_id ≤ end."""
        ids = [
            c.commit_id
            for c in self.commits()
            if c.operation == APPEND and start_exclusive < c.commit_id <= end_inclusive
        ]
        if not ids:
            return self._empty()
        return self._scan([f"{COMMIT_COL}={i}" for i in ids]).select(*self.schema.fieldNames())
