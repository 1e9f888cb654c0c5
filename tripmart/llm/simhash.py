"""SimHash near-duplicates with pigeonring candidate filtering.

Fingerprint: a text is lower-cased (A-Z), cut into words and 3-word shingles;
each shingle's XXH64 votes for 64 bits, and a bit is set when more than half of
the shingles set it.  Texts whose fingerprints differ in at most ``max_bits``
(3) bits are linked, and linked texts form one class.

Pigeonring: put the four 16-bit segments of a fingerprint on a ring.  If two
fingerprints differ in at most 3 bits, some segment starts a chain whose
cumulative differences stay within the proportional budgets l * 3 / 4, that is
0 bits in one segment, 1 in two, 2 in three, 3 in all four.  The first two
budgets are a join key: a fingerprint is stored under (start, segment, next
segment) and looked up under the same key with each single bit of the next
segment flipped, so candidates agree on 31 of 32 bits.  The third budget and
the full Hamming distance are checked on the joined rows.

The work runs over distinct fingerprints, so copies are never paired, and over
classes rather than pairs afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS = 4
SEGMENT_BITS = 16
BLOCK = 1 << 14  # shingle hashes counted at a time


def fingerprint(text: str | bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text; 0 when it has no words."""
    raw = (text or b"") if isinstance(text, bytes | None) else text.encode()
    # bytes.lower() and bytes.split() touch ASCII only: A-Z, and exactly the six white-space bytes.
    tokens = raw.lower().split()
    if not tokens:
        return 0
    k = shingle_words
    joined = b" ".join(tokens)
    n = len(tokens) - k + 1
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        return digest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[k - 1 :] - 1).tolist()
    hashes = np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts, stops, strict=True)), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].astype(">u8").view(np.uint8)).reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, *, text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with a BIGINT column ``__fp`` (the fingerprint's bits) in place of its text column."""
    keep = [c for c in docs.columns if c != text]
    # Renamed by position, so that a clashing or odd column name never reaches Arrow.
    slim = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(
                (fingerprint(x.as_py(), shingle_words) for x in batch.column(len(keep))), np.uint64, batch.num_rows
            )
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(keep))] + ["fp"])

    schema = ", ".join([f"c{i} {dict(docs.dtypes)[c]}" for i, c in enumerate(keep)] + ["fp bigint"])
    out = slim.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("fp").alias("__fp"))


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT_BITS * (i % SEGMENTS)).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _key(fp: Column, start: int) -> Column:
    """Start, its segment and the next one, packed into one BIGINT."""
    pair = F.shiftleft(_segment(fp, start), SEGMENT_BITS).bitwiseOR(_segment(fp, start + 1))
    return pair.bitwiseOR(F.lit(start << 2 * SEGMENT_BITS))


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``(a, b)``, a > b, of distinct fingerprints in ``fps(fp)`` at most ``max_bits`` (<= 3) bits apart."""
    if not 0 <= max_bits < SEGMENTS:
        raise ValueError("four segments cover up to 3 differing bits")
    fp = F.col("fp")
    starts = range(SEGMENTS)
    stored = fps.select(fp.alias("b"), F.explode(F.array(*[_key(fp, s) for s in starts])).alias("key"))
    flips = [0] + [1 << i for i in range(SEGMENT_BITS)]
    probes = [_key(fp, s).bitwiseXOR(F.lit(f).cast("bigint")) for s in starts for f in flips]
    probed = fps.select(fp.alias("a"), F.explode(F.array(*probes)).alias("key"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    start = F.shiftright(F.col("key"), 2 * SEGMENT_BITS)
    third = F.lit(0)
    for s in starts:
        chain = F.bit_count(_segment(diff, s + 1)) + F.bit_count(_segment(diff, s + 2))
        third = F.when(start == s, chain).otherwise(third)
    # All three conditions sit in the join: a crowded key yields links, never its pairs.
    near = (F.col("a") > F.col("b")) & (third <= 2) & (F.bit_count(diff) <= max_bits)
    return probed.join(stored, "key").where(near).select("a", "b").distinct()


def _classes(marked: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, component_id)``: the least ``__id`` over each linked set of fingerprints in ``marked(__id, fp)``."""
    nodes = staged(marked.groupBy("fp").agg(F.min("__id").alias("least")), "simhash-nodes")
    comp = connected_components(fingerprint_links(nodes.select("fp"), max_bits))
    rooted = nodes.join(comp, nodes.fp == comp.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicate_classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links, itself included.
    NULL and empty texts have fingerprint zero and are linked like any other;
    repeated rows stay repeated; a class whose ids are all NULL has a NULL
    component; other columns are ignored; an empty table gives no rows.
    """
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    marked = staged(with_fingerprint(slim, text="__text", shingle_words=shingle_words), "simhash")
    marked = marked.withColumnRenamed("__fp", "fp")
    return marked.join(_classes(marked, max_bits), "fp").select(
        F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_per_class(
    docs: DataFrame, *, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with one document of each near-duplicate class: the one with the least ``doc_id``.

    A NULL id ranks after all others; equal ids rank by a hash of the text;
    among repeated rows (same id and text) the least row stays.  NULL and empty
    texts form one class.  Columns must be orderable; an empty table stays empty.
    """
    content = F.xxhash64(F.coalesce("text", F.lit("")))
    slim = docs.select(F.col("doc_id").alias("__id"), content.alias("__th"), F.col("text").alias("__text"))
    marked = staged(
        with_fingerprint(slim, text="__text", shingle_words=shingle_words).withColumnRenamed("__fp", "fp"), "simhash"
    )
    rank = F.struct(F.col("__id").isNull(), F.col("__id"), F.col("__th"))
    copies = marked.groupBy("fp", "__id", "__th").agg(F.count("*").alias("__copies"))
    best = copies.groupBy("fp").agg(F.min_by(F.struct("__id", "__th", "__copies"), rank).alias("best"), F.min(rank).alias("rank"))
    best = best.join(_classes(marked, max_bits).select("fp", "root"), "fp")
    kept = best.groupBy("root").agg(F.min_by("best", "rank").alias("best")).select("best.*")
    kept = staged(kept.select(F.struct("__id").alias("__key"), "__th", "__copies"), "simhash-kept")
    # A struct key joins NULL ids too.
    keyed = docs.withColumn("__key", F.struct(F.col("doc_id").alias("__id"))).withColumn("__th", content)
    found = keyed.join(kept, ["__key", "__th"])
    names = [F.col(f"`{c}`") for c in docs.columns]
    once = found.where("__copies = 1").select(*names)
    repeated = found.where("__copies > 1").groupBy("__key", "__th").agg(F.min(F.struct(*names)).alias("row"))
    return once.union(repeated.select("row.*"))
