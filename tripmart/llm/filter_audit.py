"""How five corpus filters interact: what each removes at each place of every order.

A document is reduced to a mask with one bit per filter it fails, so a part of
the corpus is at most 32 masks, times the label flags.  Those cells, and not
the documents, are played through all 120 orders: ``transform`` runs over the
constant array of orders, ``aggregate`` folds each order's five steps, and the
resulting 600 structs, weighted with the cell's documents, are summed up
element by element over the part's cells.

Filters (a document fails when): A has under 50 words; B 100 * distinct words <
65 * words; C 100 * capitals A-Z > 5 * code points; D holds any of ``#$%&*|``;
E its text is that of a document with a smaller ``doc_id``.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, staged, words

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PCT = 65
MAX_CAPITAL_PCT = 5
MARKS = r"[#$%&*|]"

ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_masks(docs: DataFrame) -> DataFrame:
    """``(id, part, mask, digest)`` of every row: filters A to D as bits 0 to 3, and the text's SHA-256.

    A NULL text is an empty one and a NULL source the part ``''``.
    """
    df = docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # The word array is a projection of its own, so that it is built once.
    df = df.withColumn("w", words(F.col("text")))
    df = df.withColumns({"n": F.size("w"), "d": F.size(F.array_distinct("w"))})
    fails = [
        F.col("n") < MIN_WORDS,
        F.lit(100) * F.col("d") < F.lit(MIN_DISTINCT_PCT) * F.col("n"),
        F.lit(100) * F.regexp_count("text", F.lit("[A-Z]")) > F.lit(MAX_CAPITAL_PCT) * F.length("text"),
        F.col("text").rlike(MARKS),
    ]
    mask = reduce(lambda a, b: a + b, [F.when(x, F.lit(1 << i)).otherwise(F.lit(0)) for i, x in enumerate(fails)])
    return df.select("id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))


def label_flags(labels: DataFrame) -> DataFrame:
    """``(label_id, good, toxic)`` with one row per labelled ``doc_id``; a flag is set when any of its rows sets it."""
    return (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, good, toxic, n)``: documents of each part by failed filters (5 bits) and label flags.

    E is decided table-wide: the least id of every text is found first (copies
    meet as partial minima), and a row fails when it does not bear it.  That
    join is keyed by text and id together, so a text with very many copies is
    spread over all tasks.  A NULL id counts as larger than any other; rows
    that share the least id (repeated rows) all pass.
    """
    slim = staged(text_masks(docs), "audit-masks")
    least = slim.groupBy(F.col("digest").alias("text_digest")).agg(F.min("id").alias("least_id"), F.lit(True).alias("first"))
    first = slim.join(least, (F.col("digest") == F.col("text_digest")) & F.col("id").eqNullSafe(F.col("least_id")), "left")
    copied = F.when(F.col("first").isNull(), F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0))
    marked = first.select("id", "part", (F.col("mask") + copied).alias("mask"))
    flagged = marked.join(label_flags(labels), F.col("id") == F.col("label_id"), "left")
    return flagged.groupBy(
        "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    ).agg(F.count("*").alias("n"))


def _order_array() -> Column:
    """The constant array of orders, each the indices of its filters."""
    return F.array(*[F.array(*[F.lit(FILTERS.index(f)) for f in order]) for order in ORDERS])


def _counted(n: Column, **hits: Column) -> Column:
    return F.struct(*[F.when(hits[c], n).otherwise(F.lit(0).cast("long")).alias(c) for c in COUNTS])


_STEP = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def _played(cell: Column, orders: Column) -> Column:
    """The cell's 600 structs: for every order, and in it for every step, its documents under each count."""
    mask, n = cell["mask"], cell["n"]

    def step(acc: Column, i: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1), i)
        fails, gone = mask.bitwiseAND(bit) != 0, acc["gone"]
        removed = fails & ~gone
        counts = _counted(
            n,
            kept=~fails & ~gone,
            removed=removed,
            redundant=fails & gone,
            unique_fails=mask == bit,
            good_lost=removed & cell["good"],
            toxic_lost=removed & cell["toxic"],
        )
        return F.struct((gone | fails).alias("gone"), F.array_append(acc["steps"], counts).alias("steps"))

    start = F.struct(F.lit(False).alias("gone"), F.array().cast(f"array<{_STEP}>").alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda acc: acc["steps"])))


def _added(a: Column, b: Column) -> Column:
    return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: part, filter_order, step, the six counts and shapley.

    The counts are documents of the part: kept after the step, removed at it,
    redundant (failing its filter but removed before), unique_fails (failing
    its filter only), good_lost and toxic_lost (removed at it and labelled
    quality 1 or toxic 1).  ``shapley`` is what the step's filter removes,
    summed over all orders.  NULL texts are empty, NULL sources are part
    ``''``, repeated rows count each, other columns are ignored; documents
    without a label are neither good nor toxic; an empty table gives no rows.
    """
    cell = F.struct("mask", "good", "toxic", "n")
    # At most 32 masks times 4 flags a part, whatever its documents.
    parts = mask_cells(docs, labels).groupBy("part").agg(F.collect_list(cell).alias("cells"))
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS])
    steps = F.aggregate(
        "cells",
        F.array_repeat(zero, len(ORDERS) * len(FILTERS)),
        lambda acc, c: F.zip_with(acc, _played(c, _order_array()), _added),
    )
    played = parts.select("part", steps.alias("steps"))
    letters = F.lit("".join(ORDERS))
    at = F.transform(
        "steps", lambda s, i: F.struct(F.substring(letters, i + 1, F.lit(1)).alias("filter"), s.alias("s"))
    )

    def removed_by(f: str) -> Column:
        mine = F.filter("at", lambda x: x["filter"] == f)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda acc, x: acc + x["s"]["removed"]).alias(f)

    totals = F.struct(*[removed_by(f) for f in FILTERS]).alias("totals")
    totals = played.select("part", at.alias("at")).select("part", "at", totals)
    rows = totals.select("part", "totals", F.posexplode("at").alias("pos", "x"))
    names, per_order = F.array(*map(F.lit, ORDERS)), len(FILTERS)
    shapley = reduce(
        lambda other, f: F.when(F.col("x.filter") == f, F.col(f"totals.{f}")).otherwise(other), FILTERS[1:], F.col("totals.A")
    )
    return rows.select(
        "part",
        F.element_at(names, (F.floor(F.col("pos") / per_order) + 1).cast("int")).alias("filter_order"),
        (F.col("pos") % per_order + 1).cast("int").alias("step"),
        *[F.col(f"x.s.{c}").alias(c) for c in COUNTS],
        shapley.alias("shapley"),
    )


ORACLE = rf"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT *, list_filter(regexp_split_to_array(t, '{SPACE}+'), lambda x: x <> '') AS ws FROM d
), least AS (
    SELECT t, min(doc_id) AS least_id FROM d GROUP BY t
), m AS (
    SELECT w.doc_id, part,
        CASE WHEN len(ws) < {MIN_WORDS} THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(ws)) < {MIN_DISTINCT_PCT} * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * len(regexp_extract_all(w.t, '[A-Z]')) > {MAX_CAPITAL_PCT} * length(w.t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(w.t, '{MARKS}') THEN 8 ELSE 0 END
        + CASE WHEN doc_id IS DISTINCT FROM least_id THEN 16 ELSE 0 END AS mask
    FROM w JOIN least ON w.t = least.t
), l AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), cells AS (
    SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
    FROM m LEFT JOIN l ON m.doc_id = l.doc_id GROUP BY ALL
), orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM (VALUES {", ".join(f"('{f}')" for f in FILTERS)}) a(f), (VALUES {", ".join(f"('{f}')" for f in FILTERS)}) b(f),
         (VALUES {", ".join(f"('{f}')" for f in FILTERS)}) c(f), (VALUES {", ".join(f"('{f}')" for f in FILTERS)}) d(f),
         (VALUES {", ".join(f"('{f}')" for f in FILTERS)}) e(f)
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
    SELECT filter_order, step, filter_order[step] AS letter, ascii(filter_order[step]) - 65 AS bit,
        list_sum([1 << (ascii(x) - 65) FOR x IN string_split(filter_order[1:step - 1], '') IF x <> '']) AS before
    FROM orders, (VALUES (1), (2), (3), (4), (5)) s(step)
), counted AS (
    SELECT part, filter_order, step, letter,
        sum(n) FILTER (mask & coalesce(before, 0) = 0 AND (mask >> bit) & 1 = 0) AS kept,
        sum(n) FILTER (mask & coalesce(before, 0) = 0 AND (mask >> bit) & 1 = 1) AS removed,
        sum(n) FILTER (mask & coalesce(before, 0) <> 0 AND (mask >> bit) & 1 = 1) AS redundant,
        sum(n) FILTER (mask = 1 << bit) AS unique_fails,
        sum(n) FILTER (good AND mask & coalesce(before, 0) = 0 AND (mask >> bit) & 1 = 1) AS good_lost,
        sum(n) FILTER (toxic AND mask & coalesce(before, 0) = 0 AND (mask >> bit) & 1 = 1) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
    {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in COUNTS)},
    CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
