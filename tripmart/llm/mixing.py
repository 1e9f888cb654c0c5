"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weighted share of all words, at most MAX_REPEAT (3)
times its size; what a capped source cannot take is shared again by weight.

Longer documents are wanted more often: a document of 2^b to 2^(b+1) words is
wanted c = min(MAX_REPEAT, k * 2^(b * SIZE_POWER)) times, with k such that the
wanted words of the source add up to its target.  floor(c) whole copies are
certain, and its inclusion probability for one more is p = c - floor(c).

Pareto order sampling gives every document a random number u and ranks the
documents of a source by the odds u / (1 - u) divided by p / (1 - p), so that
documents of unequal probability meet in one order.  The sample is fixed in
size, measured in words: the leading documents up to what the whole copies
leave of the target, and at the end those that still fit, among the documents
of the last range (see SORT_ROWS, which therefore is a parameter of the result).

The rank is a 62-bit integer.  Where a source's sample ends is found by
histograms of 16 bins over the next 4 bits of the rank, for all large sources
at once, until the bin that holds the end has few enough documents to be
ordered.  So no source, however large, is ever sorted or gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, staged

MAX_REPEAT = 3
SIZE_POWER = 0.25  # how much more often twice as long documents are wanted, as a power of their words
SEED = 20240229
RANK_BITS, BIN_BITS = 62, 4
SORT_ROWS = 1000  # a range with so many documents or fewer is ordered exactly, and its documents tried for fit


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weights(sources: DataFrame) -> DataFrame:
    """``sources(sk, total)`` with a weight of 1, 2, 3, repeating in code point order, NULL last.

    Ranked by ranges: only a count per range reaches the driver.
    """
    spark = sources.sparkSession
    order = [F.col("sk.source").isNull(), F.col("sk.source")]
    ranged = sources.repartitionByRange(shuffle_partitions(spark), *order)
    ranged = staged(ranged.withColumn("part", F.spark_partition_id()), "source-ranges")
    before, offsets = 0, []
    for row in sorted(ranged.groupBy("part").count().collect()):
        offsets.append((row["part"], before))
        before += row["count"]
    starts = spark.createDataFrame(offsets, "part int, before long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1 + F.col("before")
    weighted = ranged.join(F.broadcast(starts), "part")  # a row per range
    return weighted.select("sk", "total", (place % 3 + 1).alias("weight"))


def source_targets(docs: DataFrame, *, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``(sk, total, weight, target)`` per source of ``docs(sk, size)``."""
    sources = staged(_weights(docs.groupBy("sk").agg(F.sum("size").alias("total"))), "sources")
    cap = F.col("total") * max_repeat
    level, capped = 0.0, -1
    while True:
        above = cap < F.col("weight") * level
        row = sources.agg(
            F.sum("total"), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)
        ).first()
        if row[2] is None or row[3] == capped:
            break
        capped = row[3]
        level = ((row[0] or 0) - (row[1] or 0)) / row[2]
    target = F.least(F.col("weight") * F.lit(level), cap.cast("double"))
    return sources.withColumn("target", target)


def size_class(size: Column) -> Column:
    """Binary digits of a document's words, less one."""
    return F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int")


def _wanted(docs: DataFrame, sources: DataFrame, max_repeat: int) -> DataFrame:
    """``(sk, cls, total, target, whole, p, rest)`` per source and size class; at most 40 classes a source.

    The classes wanted most reach ``max_repeat`` first.  With the j longest
    classes at it, the others share what is left of the target in proportion;
    the least j for which none of them exceeds it is the solution.
    """
    classes = docs.groupBy("sk", "cls").agg(F.sum("size").alias("words"))
    classes = classes.join(sources.select("sk", "total", "target"), "sk")
    f = F.pow(F.lit(2.0), F.col("cls") * F.lit(SIZE_POWER))
    down = Window.partitionBy("sk").orderBy(F.col("cls").desc())
    full = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * max_repeat
    free = F.sum(f * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    classes = classes.withColumns({"f": f, "k": F.try_divide(F.col("target") - full, free)})
    holds = F.when(F.col("k") * F.col("f") <= max_repeat * (1 + 1e-9), F.struct((-F.col("cls")).alias("at"), F.col("k").alias("k")))
    k = F.min(holds).over(Window.partitionBy("sk"))["k"]
    c = F.round(F.least(F.lit(float(max_repeat)), F.coalesce(k, F.lit(0.0)) * F.col("f")), 9)
    classes = classes.withColumn("c", c).withColumn("whole", F.floor("c")).withColumn("p", F.col("c") - F.floor("c"))
    certain = F.sum(F.col("whole") * F.col("words")).over(Window.partitionBy("sk"))
    return classes.select("sk", "cls", "total", "target", "whole", "p", (F.col("target") - certain).alias("rest"))


def _pareto_rank(key: Column, p: Column, tie: Column) -> Column:
    """Rank of a document with inclusion probability p: 40 bits of its odds ratio, then 22 that settle ties."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), key), 12).cast("double") + 0.5) / float(1 << 52)
    odds = (u / (1 - u)) * F.try_divide(1 - p, p)  # NULL where nothing is drawn
    high = F.floor(odds / (1 + odds) * float((1 << 40) - 1)).cast("long")
    return F.shiftleft(high, 22).bitwiseOR(F.shiftrightunsigned(F.xxhash64(tie), 42))


def _ends(ranked: DataFrame, sources: DataFrame) -> DataFrame:
    """``(sk, low, picked)``: each source takes once more all ranks below ``low`` and those in ``picked``."""
    state = staged(
        sources.select(
            "sk", F.col("rest").alias("need"), F.lit(0).cast("long").alias("low"), F.lit(1 << RANK_BITS).alias("width")
        ),
        "mix-level",
    )
    while True:
        inside = ranked.join(state, "sk").where(
            (F.col("rank") >= F.col("low")) & (F.col("rank") - F.col("low") < F.col("width"))
        )
        counts = inside.groupBy("sk").count()
        big = staged(counts.where((F.col("count") > SORT_ROWS)).select("sk"), "mix-big")
        if big.isEmpty() or not state.where("width > 1").join(big, "sk", "left_semi").head(1):
            break
        # The next bits of the rank cut a large source's range into bins; the bin that reaches the need is left.
        step = F.greatest(F.shiftright("width", BIN_BITS), F.lit(1).cast("long"))
        bins = inside.join(big, "sk", "left_semi").groupBy(
            "sk", "need", "low", step.alias("step"), F.floor((F.col("rank") - F.col("low")) / step).alias("bin")
        )
        bins = bins.agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("sk").orderBy("bin")
        bins = bins.withColumns({"upto": F.sum("words").over(upto), "final": F.lead("bin").over(upto).isNull()})
        hit = bins.where((F.col("upto") > F.col("need")) | F.col("final")).groupBy("sk").agg(
            F.min(F.struct("bin", "need", "low", "step", "upto", "words")).alias("x")
        )
        finer = hit.select(
            "sk",
            (F.col("x.need") - (F.col("x.upto") - F.col("x.words"))).alias("need"),
            (F.col("x.low") + F.col("x.bin") * F.col("x.step")).cast("long").alias("low"),
            F.col("x.step").alias("width"),
        )
        state = staged(state.join(big, "sk", "left_anti").union(finer), "mix-level")
    # Down the order of what is left: each document that still fits.
    tail = inside.groupBy("sk").agg(F.array_sort(F.collect_list(F.struct("rank", "size"))).alias("tail"))
    start = F.struct(F.col("need").cast("double").alias("need"), F.array().cast("array<bigint>").alias("got"))
    fits = lambda acc, x: x["size"] <= acc["need"]
    picked = F.aggregate(
        F.coalesce("tail", F.array().cast("array<struct<rank:bigint,size:bigint>>")),
        start,
        lambda acc, x: F.struct(
            F.when(fits(acc, x), acc["need"] - x["size"]).otherwise(acc["need"]).alias("need"),
            F.when(fits(acc, x), F.array_append(acc["got"], x["rank"])).otherwise(acc["got"]).alias("got"),
        ),
        lambda acc: acc["got"],
    )
    return state.join(tail, "sk", "left").select("sk", "low", "width", picked.alias("picked"))


def mix(docs: DataFrame, *, carry: list[str] | None = None, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per document: the ``carry`` columns, size, source_size, target and copies (0 to ``max_repeat``).

    NULL and empty texts have size 0; a NULL source is the last source; a NULL
    doc_id and repeated rows are documents like others; with no words at all
    nothing is taken; an empty table gives no rows.  The random numbers come
    from doc_id and text, so that reruns agree.
    """
    carry = ["doc_id"] if carry is None else carry
    slim = docs.select(
        F.struct("source").alias("sk"),
        n_words(F.col("text")).alias("size"),
        F.xxhash64("doc_id", "text").alias("key"),
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
    )
    slim = staged(slim.withColumn("cls", size_class(F.col("size"))), "mix-documents")
    sources = source_targets(slim, max_repeat=max_repeat)
    wanted = staged(_wanted(slim, sources, max_repeat), "mix-wanted")
    drawn = wanted.where("p > 0")
    # Identical rows tie in their key; their place in the written table tells them apart.
    placed = slim.withColumn("tie", F.monotonically_increasing_id())
    rank = _pareto_rank(F.col("key"), F.col("p"), F.col("tie"))
    ranked = placed.select("sk", "cls", "size", "key", "tie").join(drawn.select("sk", "cls", "p"), ["sk", "cls"])
    ends = _ends(staged(ranked.select("sk", "size", rank.alias("rank")), "mix-ranks"), drawn.select("sk", "rest").distinct())
    known = staged(wanted.join(ends, "sk", "left"), "mix-ends")
    out = placed.join(known, ["sk", "cls"])
    inside = (rank - F.col("low") < F.col("width")) & F.array_contains("picked", rank)
    extra = F.when((F.col("p") > 0) & ((rank < F.col("low")) | inside), 1).otherwise(0)
    return out.select(
        "row.*", "size", F.col("total").alias("source_size"), "target", (F.col("whole") + extra).cast("int").alias("copies")
    )


def mixed_documents(docs: DataFrame, *, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mix itself: each document of ``docs`` as often as it is taken, with the columns of ``docs``."""
    names = list(docs.columns)
    taken = mix(docs.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in names])), carry=["__row"], max_repeat=max_repeat)
    return taken.where("copies > 0").select(F.explode(F.array_repeat("__row", F.col("copies"))).alias("r")).select("r.*")
