"""Document fingerprints from closed syncmers, in DataFrame expressions only.

A text is lower-cased and cut into words.  Every run of K (9) words is a
k-mer and has K - S + 1 (8) inner s-mers of S (2) words; it is a closed syncmer when
its least s-mer hash lies at its first or last s-mer.  Whether a k-mer is chosen
depends on its own words alone, so equal passages give equal anchors wherever
they stand.  An anchor is a k-mer's hash with its word position.  Of 15 words on
at least one k-mer is chosen; a shorter text without a chosen one is anchored at
its k-mer of least hash.

Positional matching compares texts by links: an anchor together with the next
one and the distance between them.  Likeness is the Jaccard similarity of the
distinct links (the first anchor links with the text's beginning).

Whether a k-mer is chosen is asked of its 8 s-mer hashes by place, and only
chosen ones are hashed, so that the work is linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, words, zip_shifted

K, S = 9, 2  # an s-mer is hashed as two neighbouring words


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the anchors ``array<struct<h: bigint, p: int>>`` of column ``text``, by position.

    A text of 1 to 8 words has one anchor, the hash of them all; a longer one
    has its closed syncmers, or its k-mer of least hash if there are none; a
    text without words (or NULL) has no anchor.
    """
    t = lambda i: f"__{out}_{i}"
    df = df.withColumn(t("w"), F.transform(words(F.lower(text)), lambda w: F.xxhash64(w)))
    df = df.withColumn(t("s"), zip_shifted(F.col(t("w")), F.col(t("w")), S - 1, lambda a, b: F.xxhash64(a, b)))
    n = F.size(t("w"))
    every = F.sequence(F.lit(0), F.greatest(n - K, F.lit(0)))  # where k-mers begin
    smer = lambda p: F.get(t("s"), p)
    inner = lambda p: F.least(*[smer(p + j) for j in range(1, K - S)])
    df = df.withColumn(t("a"), F.filter(every, lambda p: F.least(smer(p), smer(p + K - S)) <= inner(p)))

    def anchor(p: Column) -> Column:
        return F.struct(F.xxhash64(*[F.get(t("w"), p + j) for j in range(K)]).alias("h"), p.alias("p"))

    chosen = F.transform(t("a"), anchor)
    anchors = F.when(F.size(t("a")) == 0, F.array(F.array_min(F.transform(every, anchor)))).otherwise(chosen)
    whole = F.array(F.struct(F.xxhash64(t("w")).alias("h"), F.lit(0).alias("p")))
    none = F.slice(whole, 1, 0)
    short = F.when(n == 0, none).otherwise(whole)
    df = df.withColumn(out, F.when(n < K, short).otherwise(anchors))
    return df.drop(t("w"), t("s"), t("a"))


def as_string(anchors: Column) -> Column:
    """Anchors as ``hash:position`` in hex, comma-joined; empty for none."""
    shown = lambda x: F.concat(F.hex(x["h"]), F.lit(":"), F.hex(x["p"].cast("bigint")))
    return F.lower(F.array_join(F.transform(anchors, shown), ","))


def links(anchors: Column) -> Column:
    """One hash for each anchor, the anchor before it and the distance between them."""
    n = F.greatest(F.size(anchors) - 1, F.lit(0))
    start = F.array(F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("p")))
    before = F.concat(start, F.slice(anchors, 1, n))
    joined = F.zip_with(F.slice(before, 1, F.size(anchors)), anchors, lambda a, b: F.xxhash64(a["h"], b["h"], b["p"] - a["p"]))
    return F.array_distinct(joined)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of links; 1 when both are empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        F.coalesce(shared / F.nullif(F.size(a) + F.size(b) - shared, F.lit(0)), F.lit(0.0))
    )


SLOT_BITS = 12  # rows of one id, or without one, are dealt by this many leading bits of their text hash


def _listed(values: list, kind: str) -> Column:
    """Numbers as one folded array, however many there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _ranges(keys: DataFrame, buckets: int) -> tuple[list[int], list[int]]:
    """Ascending bounds that cut the ids into about ``buckets`` even ranges, and the ids that fill a range by themselves."""
    at = _listed([i / buckets for i in range(1, buckets)], "double")
    found = keys.agg(F.percentile_approx("doc_id", at, max(10_000, 4 * buckets)).alias("q")).first()["q"] or []
    return sorted(set(found)), sorted({a for a, b in zip(found, found[1:]) if a == b})


def _bucket(doc_id: Column, text_hash: Column, bounds: list[int], hot: list[int]) -> Column:
    """The range of a row, ascending with (doc_id, text hash), NULL ids lowest.

    The number of bounds that are at most ``doc_id`` is found by binary search.
    A hot id is the lowest of its range; its rows, and those without an id, have
    2**SLOT_BITS ranges of text hashes.
    """
    slots = 1 << SLOT_BITS
    slot = F.shiftright(text_hash, 64 - SLOT_BITS) + slots // 2
    found = F.lit(0)
    if bounds:
        table = _listed(bounds, "bigint")
        steps = _listed([1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)], "int")
        found = F.aggregate(
            steps,
            F.lit(0),
            lambda acc, step: F.when(
                F.coalesce(F.get(table, acc + step - 1) <= doc_id, F.lit(False)), acc + step
            ).otherwise(acc),
        )
    rest = F.when(F.array_contains(_listed(hot, "bigint"), doc_id.cast("bigint")), slot) if hot else F.lit(None)
    return F.when(doc_id.isNull(), slot - 2 * slots).otherwise(
        found.cast("bigint") * (2 * slots) + F.coalesce(rest, F.lit(slots))
    )


def with_next(docs: DataFrame, columns: list[str], derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``docs`` with ``next_<c>`` of the next document by descending doc_id; after the last comes the first.

    NULL ids come last; equal ids rank by text hash.  Documents are dealt by
    ranges of ids (those of one id, or of none, by ranges of text hashes); each
    range also gets a copy of the first document of the range after it, so one
    shuffle of the texts settles every neighbour.  ``derive`` adds columns of
    each document before that shuffle; ``columns`` may name them.
    """
    keys = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("__th"))
    bounds, hot = _ranges(keys, 4 * shuffle_partitions(docs.sparkSession))
    ranged = docs.withColumn("__th", F.xxhash64(F.coalesce("text", F.lit(""))))
    place = _bucket(F.col("doc_id"), F.col("__th"), bounds, hot)
    ranged = ranged.withColumn("__b", place)
    # The first document of each range: as many rows as ranges, from ids and hashes alone.
    heads = keys.groupBy(place.alias("__b")).agg(F.max(F.struct("doc_id", "__th")).alias("head"))
    found = sorted(((r["__b"], r["head"]) for r in heads.collect()), key=lambda x: x[0])
    # A range's last document is followed by the first one of the range below; the lowest range's by the top's.
    lent = [(h["doc_id"], h["__th"], found[(i + 1) % len(found)][0]) for i, (_, h) in enumerate(found)]
    spark = docs.sparkSession
    lend = spark.createDataFrame(lent, f"__id {dict(docs.dtypes)['doc_id']}, __h bigint, __to bigint")
    guests = ranged.join(F.broadcast(lend), ranged["doc_id"].eqNullSafe(lend["__id"]) & (ranged["__th"] == lend["__h"]))
    guests = guests.select(*[F.col("__to").alias("__b") if c == "__b" else F.col(f"`{c}`") for c in ranged.columns])
    guests = guests.dropDuplicates(["__b"])  # repeated rows have the same text
    both = derive(ranged.withColumn("__guest", F.lit(0)).union(guests.withColumn("__guest", F.lit(1))))
    names = [f"`{c}`" for c in columns]
    order = "PARTITION BY __b ORDER BY __guest, doc_id DESC NULLS LAST, __th DESC"
    nexts = [F.expr(f"lead({n}) OVER ({order})").alias(f"next_{c}") for n, c in zip(names, columns, strict=True)]
    seen = both.select("*", *nexts).where("__guest = 0")
    return seen.drop("__b", "__th", "__guest")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, fingerprints of its text and edited text, and likenesses.

    A NULL text counts as empty; empty texts have an empty fingerprint, and two
    of those are alike (1); a single document is its own next one; repeated
    rows follow each other; other columns are ignored; an empty table gives no rows.
    Likeness follows from the strings, which show every anchor whole.
    """

    def own(df: DataFrame) -> DataFrame:
        df = with_anchors(df, "text", "fp")
        return df.withColumns({"h": F.col("fp.h"), "p": F.col("fp.p")}).drop("fp")  # small in a shuffle

    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    slim = with_next(slim, ["text", "h", "p"], own)  # anchors of the text serve the document and the one before it
    slim = slim.withColumns(
        {
            "fp": F.arrays_zip("h", "p"),
            "next_fp": F.arrays_zip(F.col("next_h").alias("h"), F.col("next_p").alias("p")),
            "edited": edited(F.col("text"), F.col("next_text")),
        }
    )
    slim = with_anchors(slim, "edited", "edited_fp")
    slim = slim.withColumns({"l": links(F.col("fp")), "le": links(F.col("edited_fp")), "ln": links(F.col("next_fp"))})
    return slim.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_string(F.col("fp")).alias("fingerprint"),
        as_string(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("l"), F.col("le")).alias("near_edited"),
        likeness(F.col("l"), F.col("ln")).alias("near_next"),
    )
