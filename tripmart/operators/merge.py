"""Upsert (MERGE) of a source frame into a target frame, as DataFrame operations.

Semantics of ``MERGE INTO target USING source ON keys``:
``WHEN MATCHED THEN UPDATE SET <all but preserved columns>``,
``WHEN NOT MATCHED THEN INSERT *``; target rows without a source match stay.

Plan: one full outer join on the keys.  Each side is shuffled once on the
keys, and every output column is a ``CASE`` on which side matched, so nothing is
joined twice and no side is broadcast blindly.  Duplicate source keys are found
inside that exchange: rows are numbered per key, over the partitioning and order
that the join needs anyway, and a second row of a key ends the job when it
runs.  The numbering holds one row at a time, so a key with very many rows fails
at its second row.  AQE cannot split skewed partitions of a full outer join, but
none can arise where the source is checked or deduplicated: every join key then
carries at most two rows.  ``on_duplicate="pairs"`` gives that join's rows as they
are: a key with m source and n target rows then has m * n of them in the result.

Where several source rows of one key are to replace that key's target rows
(``on_duplicate="replace"``) there is no join, whose rows would be the product of
both sides: the sides are put below each other and shuffled once on the keys,
and each row is told whether its key has rows of the other side.

When the target is partitioned on columns that the key determines (trip_id
fixes the pickup month), ``scope`` restricts the target to the partitions the
source touches: the rest of the table is neither read into the join nor
rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_T, _S = "t__", "s__"
_IN_T, _IN_S = "__target_row", "__source_row"
_NTH = "__nth_of_key"
_MATCHED, _KEPT = "__in_source_too", "__kept"
SIGN = "change_sign"


@dataclass
class MergeResult:
    merged: DataFrame  # new contents of the scoped partitions (or the whole table)
    scope: list[dict[str, object]] | None  # partitions rewritten; None = whole table
    changes: DataFrame | None = None  # source rows (+1) and the target rows they replace (-1), with a column SIGN

    def full_table(self, target: DataFrame) -> DataFrame:
        """Merged rows plus the untouched target partitions (the complete new table)."""
        if self.scope is None:
            return self.merged
        return target.filter(~any_of(self.scope)).unionByName(self.merged)


def any_of(parts: list[dict[str, object]]) -> Column:
    """Whether a row lies in one of the partitions (null-safe), as flat ``IN`` lists.

    Partitions that agree in all columns but the last share one list, and the
    lists are OR-ed pairwise, so thousands of partitions make a shallow predicate.
    """
    if not parts:
        return F.lit(False)
    *outer, last = parts[0]
    lists: dict[tuple, list[object]] = {}
    for part in parts:
        lists.setdefault(tuple(part[c] for c in outer), []).append(part[last])
    terms = []
    for prefix, values in lists.items():
        known = [v for v in values if v is not None]
        hit = F.coalesce(F.col(last).isin(known), F.lit(False)) if known else F.lit(False)
        if len(known) < len(values):
            hit = hit | F.col(last).isNull()
        terms.append(reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(outer, prefix, strict=True)], hit))
    while len(terms) > 1:
        terms = [reduce(lambda a, b: a | b, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]


def _numbered(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.withColumn(_NTH, F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))


def _refuse(df: DataFrame, bad: Column, keys: Sequence[str]) -> DataFrame:
    """``df``, whose evaluation fails at a row for which ``bad`` holds."""
    message = F.lit(f"MERGE source has duplicate keys on {list(keys)}")
    return df.filter(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source``, whose evaluation fails at the second row of a key (for loads that join nothing)."""
    return _refuse(_numbered(source, keys), F.col(_NTH) > 1, keys).drop(_NTH)


def touched_partitions(source: DataFrame, scope_cols: Sequence[str]) -> list[dict[str, object]]:
    """Distinct values of the scope columns in ``source``."""
    rows = source.select(*scope_cols).distinct().collect()
    return [r.asDict() for r in rows]


def dedupe_source(source: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``latest_by`` values.

    ``max_by`` is an ordinary aggregate, so the partial (map-side) step
    collapses a hot key before the shuffle instead of routing all of its rows
    to one task.
    """
    if not latest_by:
        raise ValueError("on_duplicate='dedupe' needs latest_by columns")
    rest = [c for c in source.columns if c not in keys]
    # All other columns settle ties, so that reruns pick the same row.
    order = [*latest_by, *[c for c in rest if c not in latest_by]]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return source.groupBy(*keys).agg(best).select(*keys, "__row.*").select(*source.columns)


def _replace(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    preserve: Sequence[str],
    null_safe: bool,
    delete_missing: bool,
) -> tuple[DataFrame, DataFrame]:
    """Merged rows and changes where all source rows of a key replace all of its target rows; no row is paired."""
    columns = target.columns
    both = target.withColumn(_IN_S, F.lit(False)).unionByName(source.select(*columns).withColumn(_IN_S, F.lit(True)))
    in_source, of_key = F.col(_IN_S), Window.partitionBy(*keys)
    # '=' keys: a NULL key matches nothing.
    known = F.lit(True) if null_safe else reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    told = {_MATCHED: known & F.max(_IN_S).over(of_key)}
    if preserve:  # those of the key's target row that has the least
        kept = F.when(~in_source, F.struct(*[F.col(c) for c in preserve]))
        told[_KEPT] = F.when(known & in_source, F.min(kept).over(of_key))
    both = both.withColumns(told)
    if preserve:
        old = F.col(_KEPT).isNotNull()
        both = both.withColumns({c: F.when(old, F.col(f"{_KEPT}.`{c}`")).otherwise(F.col(c)) for c in preserve})
    gone = F.lit(True) if delete_missing else F.col(_MATCHED)
    sign = F.when(in_source, F.lit(1)).otherwise(F.lit(-1)).alias(SIGN)
    return both.filter(in_source | ~gone).select(*columns), both.filter(in_source | gone).select(sign, *columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    preserve: Sequence[str] = (),
    null_safe: bool = False,
    scope_cols: Sequence[str] | None = None,
    on_duplicate: str = "error",
    latest_by: Sequence[str] = (),
    delete_missing: bool = False,
) -> MergeResult:
    """Merge ``source`` into ``target`` on ``keys``.

    ``preserve`` columns keep the target's value on a match (e.g. created_at);
    ``null_safe`` matches NULL keys to NULL keys (``<=>``) so NULL groups are
    updated instead of re-inserted.  ``delete_missing`` adds ``WHEN NOT MATCHED
    BY SOURCE THEN DELETE`` (within the scope): the result mirrors the source.

    ``on_duplicate`` says what several source rows of one key do: ``error``
    fails the job that evaluates the result, ``insert`` fails only where they
    match a target row and otherwise inserts them all (a plain MERGE),
    ``replace`` writes each of them once in place of all target rows of the key
    (preserved values: of the target row that has the least), ``pairs`` writes
    each once per target row that it matches, as an outer join does, and
    ``dedupe`` keeps the row that is greatest by ``latest_by``.
    """
    columns = target.columns
    if on_duplicate not in ("error", "insert", "replace", "pairs", "dedupe"):
        raise ValueError(f"unknown on_duplicate={on_duplicate!r}")
    if on_duplicate == "dedupe":
        source = dedupe_source(source, keys, latest_by)
    # Reads the scope columns only; no key is shuffled for it.
    scope = touched_partitions(source, scope_cols) if scope_cols else None
    if scope is not None:
        target = target.filter(any_of(scope))
    if on_duplicate == "replace":
        merged, changes = _replace(target, source, keys, preserve, null_safe, delete_missing)
        return MergeResult(merged, scope, changes)
    s = source.select(*[F.col(c).alias(_S + c) for c in columns], F.lit(True).alias(_IN_S))
    if on_duplicate != "dedupe":
        s = _numbered(s, [_S + k for k in keys])
    t = target.select(*[F.col(c).alias(_T + c) for c in columns], F.lit(True).alias(_IN_T))

    def key_eq(k: str) -> Column:
        left, right = F.col(_T + k), F.col(_S + k)
        return left.eqNullSafe(right) if null_safe else left == right

    joined = t.join(s, reduce(lambda a, b: a & b, [key_eq(k) for k in keys]), "full_outer")
    in_source, in_target = F.col(_IN_S).isNotNull(), F.col(_IN_T).isNotNull()
    if on_duplicate in ("error", "insert"):
        repeated = F.col(_NTH) > 1
        joined = _refuse(joined, repeated if on_duplicate == "error" else repeated & in_target, keys)

    out = []
    for c in columns:
        if c in preserve:  # set on insert only
            expr = F.when(in_target, F.col(_T + c)).otherwise(F.col(_S + c))
        else:  # matched → source value; target-only rows unchanged
            expr = F.when(in_source, F.col(_S + c)).otherwise(F.col(_T + c))
        out.append(expr.alias(c))
    gone = in_target if delete_missing else in_target & in_source
    if on_duplicate == "pairs":  # a target row counts once, however many source rows match it
        gone = gone & (F.coalesce(F.col(_NTH), F.lit(1)) == 1)
    rows = F.filter(
        F.array(
            F.struct(F.lit(-1).alias(SIGN), gone.alias("counts"), *[F.col(_T + c).alias(c) for c in columns]),
            F.struct(F.lit(1).alias(SIGN), in_source.alias("counts"), *out),
        ),
        lambda x: x["counts"],
    )
    changes = joined.select(F.explode(rows).alias("x")).select(f"x.{SIGN}", *[F.col(f"x.{c}").alias(c) for c in columns])
    if delete_missing:
        joined = joined.filter(in_source)
    return MergeResult(joined.select(*out), scope, changes)
