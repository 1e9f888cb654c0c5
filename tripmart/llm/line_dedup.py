"""Line dedup by a segment-partition edit join, in DataFrame expressions only.

Lines of at least ``MIN_CHARS`` code points are compared; two lines are alike
when at most TAU (2) edits turn one into the other.  If they are, then of the
TAU + 1 even segments of the shorter line one occurs unchanged in the longer
one, close to its place.  So every line stores a key for each of its segments,
under its length, and looks up, for each length up to TAU shorter, the
substrings that the multi-match-aware windows allow.  Joined lines whose letter
counts are too far apart are dropped in the join condition, the rest is
verified with a banded bit-parallel edit distance over the part between common
prefix and suffix.

Alike lines form classes (connected); the first line of a class by (doc_id, text
hash, line number) stays in its document, all others are dropped.  Equal lines
are one line for the join, so frequent lines cost one row.

Shorter lines take part in exact repeats only: from ``EXACT_CHARS`` code points
on if they hold a letter or digit, by one grouped hash and without the join.

A line is identified by a 64-bit hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import connected_components

TAU = 2
MIN_CHARS = 40
EXACT_CHARS = 6
# Letters whose counts are compared before the strings are; any letters give right results.
COUNTED = "eantiorslhdcumg"


def _bounds(length: Column, i: int, tau: int) -> tuple[Column, Column]:
    """Start (1-based) and length of segment i (0-based) of a line; the last ones are one longer."""
    base = F.floor(length / (tau + 1)).cast("int")
    longer = length % (tau + 1)  # so many segments at the end have one more
    before = F.greatest(longer - (tau + 1 - i), F.lit(0))
    size = base + F.when(F.lit(i) >= tau + 1 - longer, 1).otherwise(0)
    return base * i + before + 1, size


def _windows(delta: int, i: int, tau: int) -> range:
    """Shifts of segment i at which a line that is ``delta`` longer may hold it (multi-match-aware)."""
    rest = tau - i
    return range(max(-i, delta - rest), min(i, delta + rest) + 1)


def _with_signature(lines: DataFrame) -> DataFrame:
    """``lines`` with ``sig``: a line's length and its count of each COUNTED letter, modulo 16, four bits each.

    Counted letters are taken out, one column a step, so each search has less to read.
    """
    total = F.length("line").bitwiseAND(F.lit(15)).cast("bigint")
    rest = "line"
    for i, letter in enumerate(COUNTED, 1):
        lines = lines.withColumn(f"__r{i}", F.replace(F.col(rest), F.lit(letter), F.lit("")))
        count = F.octet_length(rest) - F.octet_length(f"__r{i}")  # the letters are one byte each
        total = total.bitwiseOR(F.shiftleft(count.bitwiseAND(F.lit(15)).cast("bigint"), 4 * i))
        rest = f"__r{i}"
    return lines.withColumn("sig", total)


def _letters_apart(a: Column, b: Column) -> Column:
    """Sum over the letters of how far two signatures' counts are apart; an edit adds 2 at most."""
    total = F.lit(0).cast("bigint")
    for i in range(1, len(COUNTED) + 1):
        d = (F.shiftrightunsigned(a, 4 * i) - F.shiftrightunsigned(b, 4 * i)).bitwiseAND(F.lit(15))
        total = total + F.least(d, 16 - d)
    return total


def _parity(parts: Column) -> Column:
    """A parity bit for each of 64 classes of a line's characters."""
    one = F.lit(1).cast("bigint")
    bit = lambda w: F.call_function("shiftleft", one, F.xxhash64(w).bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, w: acc.bitwiseXOR(bit(w)))


def _keys(line: Column, length: Column, tau: int) -> tuple[Column, Column]:
    """Keys a line is stored under, and keys it looks up."""
    stored, looked = [], []
    base, least = (F.floor((length - d) / (tau + 1)).cast("int") for d in (0, tau))
    for i in range(tau + 1):
        # The stretch that holds segment i at all its places, so that each is cut from a short string.
        begin = F.greatest(least * i + 1 - i, F.lit(1))
        stretch = F.substring(line, begin, base + 4 * i + 4)
        start, size = _bounds(length, i, tau)
        stored.append(F.xxhash64(F.lit(i), length, F.substring(stretch, start - begin + 1, size)))
        for delta in range(tau + 1):
            short = (length - delta).cast("int")
            at, size = _bounds(short, i, tau)
            for shift in _windows(delta, i, tau):
                # Never before the line's start: segments before this one are longer than the shift.
                looked.append(F.xxhash64(F.lit(i), short, F.substring(stretch, at + shift - begin + 1, size)))
    return F.array(*stored), F.array(*looked)


def _lines(docs: DataFrame, min_chars: int, exact_chars: int | None = None) -> DataFrame:
    """``(doc_id, th, pos, line, length, h)`` for each line of ``min_chars``, or of ``exact_chars`` with a letter or digit."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    lines = lines.withColumn("length", F.length("line"))
    wanted = F.col("length") >= min_chars
    if exact_chars is not None:
        wanted = wanted | ((F.col("length") >= exact_chars) & F.col("line").rlike(r"[\p{L}\p{N}]"))
    return lines.where(wanted).withColumn("h", F.xxhash64("line"))


def _common_prefix(a: Column, b: Column) -> Column:
    """Code points at the start that both strings share, by binary search."""
    limit = F.least(F.length(a), F.length(b))
    return F.aggregate(
        F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]),
        F.lit(0),
        lambda acc, step: F.when(
            (step <= limit - acc) & (F.substring(a, acc + 1, step) == F.substring(b, acc + 1, step)), acc + step
        ).otherwise(acc),
    )


def trimmed(df: DataFrame, a: str, b: str) -> DataFrame:
    """``df`` with ``__a`` and ``__b``: strings a and b without common prefix and suffix, reversed."""
    cut = lambda c, n: F.expr(f"substring(`{c}`, {n} + 1)")
    df = df.withColumn("__p", _common_prefix(F.col(a), F.col(b)))
    df = df.withColumns({"__a": F.reverse(cut(a, "__p")), "__b": F.reverse(cut(b, "__p"))})
    df = df.withColumn("__s", _common_prefix(F.col("__a"), F.col("__b")))
    return df.withColumns({"__a": cut("__a", "__s"), "__b": cut("__b", "__s")}).drop("__p", "__s")


def may_be_within(a: Column, b: Column, tau: int) -> Column:
    """False only for trimmed strings that are more than ``tau`` edits apart.

    Their first and last characters cost an edit each, so what lies between
    has at most tau - 2, and one of tau - 1 pieces of it occurs unchanged.
    """
    short = F.greatest(F.length(a), F.length(b)) <= tau
    if tau < 2:
        return short
    size = F.length(a) - 2
    pieces = F.lit(False)
    for i in range(tau - 1):
        start, stop = F.floor(size * i / (tau - 1)), F.floor(size * (i + 1) / (tau - 1))
        pieces = pieces | F.contains(b, F.substring(a, (start + 2).cast("int"), (stop - start).cast("int")))
    return short | pieces


def banded_distance(df: DataFrame, tau: int) -> DataFrame:
    """``df`` with the edit distance of ``__a`` and ``__b`` as ``distance``, or a number over ``tau``.

    Lengths must differ by at most ``tau``.  One BIGINT holds the 2 tau + 1
    cells of a column of the dynamic programme that lie in the band around the
    diagonal; each character of b moves it on with a few bit operations.
    """
    width = 2 * tau + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    lit = lambda x: F.lit(x).cast("bigint")
    # Both middles end in the same tau + 1 sentinels, so that the band never runs out of rows.
    tail = F.array(*[F.lit("")] * (tau + 1))
    chars = lambda c: F.concat(F.filter(F.split(F.col(c), ""), lambda x: x != ""), tail)
    df = df.withColumns({"__a": chars("__a"), "__b": chars("__b")})
    # What b meets in the band at step j: the tau characters of a before it, its own and tau after.
    empty = F.array_repeat(F.lit(None).cast("string"), tau)
    df = df.withColumn("__n", F.size("__a"))
    padded = F.concat(empty, F.col("__a"), empty)
    met = {f"__x{k}": F.slice(padded, F.lit(k + 1), F.greatest(F.size("__b"), F.lit(1))) for k in range(width)}
    df = df.withColumns(met)

    def bits(x: Column) -> Column:
        hit = [F.when(x[f"__x{k}"] == x["__b"], lit(1 << k)).otherwise(lit(0)) for k in range(width)]
        return reduce(lambda p, q: p.bitwiseOR(q), hit)

    df = df.withColumn("__m", F.transform(F.arrays_zip("__b", *[f"__x{k}" for k in range(width)]), bits))

    def step(acc: Column, m: Column) -> Column:
        inverse = lambda v: v.bitwiseXOR(lit(full))
        vp, vn, j = acc["vp"], acc["vn"], acc["j"] + 1
        d0 = (m.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(m).bitwiseOR(vn).bitwiseAND(lit(full))
        hp = vn.bitwiseOR(inverse(d0.bitwiseOR(vp)))
        hn = d0.bitwiseAND(vp)
        half = F.shiftright(d0, 1)
        # The score follows the band's last row down the diagonal, then runs along the last row of a.
        flat = F.greatest(acc["j"] + 1 + tau - acc["n"], F.lit(0))
        at = F.call_function("shiftrightunsigned", lit(top), flat)
        down = F.when(d0.bitwiseAND(lit(top)) == 0, 1).otherwise(0)
        along = F.when(hp.bitwiseAND(at) != 0, 1).when(hn.bitwiseAND(at) != 0, -1).otherwise(0)
        return F.struct(
            hn.bitwiseOR(inverse(half.bitwiseOR(hp))).alias("vp"),
            half.bitwiseAND(hp).alias("vn"),
            j.alias("j"),
            acc["n"].alias("n"),
            (acc["score"] + F.when(flat == 0, down).otherwise(along)).alias("score"),
        )

    start = F.struct(
        lit(full ^ ((1 << tau) - 1)).alias("vp"), lit(0).alias("vn"), F.lit(0).alias("j"), F.col("__n").alias("n"), F.lit(tau).alias("score")
    )
    return df.withColumn("distance", F.aggregate("__m", start, step, lambda acc: acc["score"])).drop(
        "__a", "__b", "__n", "__m", *met
    )


def _candidates(docs: DataFrame, tau: int, min_chars: int) -> DataFrame:
    """Pairs of different lines that share a segment where it may lie and have close letter counts."""
    lines = _lines(docs, min_chars)
    stored, looked = _keys(F.col("line"), F.col("length"), tau)
    # The keys follow from the line: distinct keeps one row for equal lines, mostly before the shuffle.
    rows = _with_signature(lines).select("h", "length", "sig", stored.alias("stored"), looked.alias("looked"))
    rows = staged(rows.distinct().drop("length"), "line-keys")  # read for both sides
    left = rows.select(F.explode("looked").alias("key"), F.col("h").alias("ha"), F.col("sig").alias("sa"))
    right = rows.select(F.explode("stored").alias("key"), F.col("h").alias("hb"), F.col("sig").alias("sb"))
    close = _letters_apart(F.col("sa"), F.col("sb")) <= 2 * tau
    # Lines of one length find each other both ways; one way is enough.
    once = (F.col("sa").bitwiseXOR(F.col("sb")).bitwiseAND(F.lit(15)) != 0) | (F.col("ha") > F.col("hb"))
    if tau > 7:
        raise ValueError("four bits tell lengths and counts apart for up to 7 edits")
    return left.join(right, "key").where((F.col("ha") != F.col("hb")) & once & close).select(
        F.greatest("ha", "hb").alias("a"), F.least("ha", "hb").alias("b")
    ).distinct()


def line_links(docs: DataFrame, *, tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """Pairs ``(a, b)`` of hashes of different lines at most ``tau`` edits apart."""
    pairs = staged(_candidates(docs, tau, min_chars), "line-pairs")
    ids = staged(pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct(), "line-ids")
    lines = _lines(docs, min_chars).select("h", "length", "line")
    # Only lines of some candidate are carried on, and one of each.
    named = lines.join(_small(ids), "h", "left_semi").groupBy("h").agg(F.min("line").alias("line"))
    # One edit flips two characters' parity at most; this settles most pairs that differ in a word.
    named = staged(named.withColumn("sig", _parity(F.split("line", ""))), "line-texts")
    both = pairs.join(named.select(F.col("h").alias("a"), F.col("sig").alias("sa"), F.col("line").alias("x")), "a")
    both = both.join(named.select(F.col("h").alias("b"), F.col("sig").alias("sb"), F.col("line").alias("y")), "b")
    close = F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= 2 * tau
    both = both.where(close & (F.abs(F.length("x") - F.length("y")) <= tau)).drop("sa", "sb")
    # Written before each filter, which Spark would otherwise push below, copying the steps into itself.
    middles = staged(trimmed(both, "x", "y").select("a", "b", "__a", "__b"), "line-middles")
    middles = middles.where(may_be_within(F.col("__a"), F.col("__b"), tau))
    checked = staged(banded_distance(middles, tau).select("a", "b", "distance"), "line-distances")
    return checked.where(F.col("distance") <= tau).select("a", "b")


SMALL_ROWS = 4_000_000  # 8-byte hashes: 32 MB at most


def _small(ids: DataFrame) -> DataFrame:
    """``ids`` (one BIGINT per row), broadcast if counted to be small; else joined by shuffle."""
    return F.broadcast(ids) if ids.count() <= SMALL_ROWS else ids


def dropped_lines(
    docs: DataFrame, *, tau: int = TAU, min_chars: int = MIN_CHARS, exact_chars: int = EXACT_CHARS
) -> DataFrame:
    """``(doc_id, th, dropped)``: sorted numbers (from 0) of the lines to drop, for documents that have any.

    ``th`` is the text's hash; repeated rows (same doc_id and text) count as one document.
    """
    links = line_links(docs, tau=tau, min_chars=min_chars)
    classes = connected_components(links)
    where = _lines(docs, min_chars, exact_chars).select("doc_id", "th", "pos", "h")
    where = staged(where, "line-places")
    place = F.struct("doc_id", "th", "pos")
    firsts = where.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = firsts.join(classes, firsts.h == classes.node, "left").withColumn("root", F.coalesce("root", "h"))
    firsts = staged(firsts.where("n > 1 OR node IS NOT NULL").select("h", "root", "first"), "line-firsts")
    best = firsts.groupBy("root").agg(F.min("first").alias("first"))
    best = firsts.select("h", "root").join(best, "root").select("h", "first")
    late = where.join(best, "h").where(place > F.col("first"))
    return late.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))


def dedup_lines(
    docs: DataFrame, *, tau: int = TAU, min_chars: int = MIN_CHARS, exact_chars: int = EXACT_CHARS, report: bool = True
) -> DataFrame:
    """``docs`` with each dropped line taken out of its text, and columns n_lines, n_dropped and dropped.

    A column of ``docs`` with one of these three names is replaced; without
    ``report`` the columns are those of ``docs`` as they are.

    Lines are split at newlines; lines under ``min_chars`` code points go
    only as exact repeats, those under ``exact_chars`` or without a letter or digit stay.  A
    NULL text stays NULL (no lines), an empty one empty; a document may lose
    all its lines; a NULL doc_id comes first in the order of documents; repeated
    rows are one document and get the same result; an empty table stays empty.
    """
    lost = staged(dropped_lines(docs, tau=tau, min_chars=min_chars, exact_chars=exact_chars), "line-dropped")
    lost = lost.select(F.struct("doc_id").alias("__key"), F.col("th").alias("__th"), F.col("dropped").alias("__dropped"))
    keyed = docs.withColumns(
        {"__key": F.struct("doc_id"), "__th": F.xxhash64(F.coalesce("text", F.lit("")))}
    )
    found = keyed.join(lost, ["__key", "__th"], "left")
    lines = F.split("text", "\n")
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    left = F.filter(numbered, lambda x: ~F.array_contains(F.col("__dropped"), x["i"]))
    text = F.when(F.col("__dropped").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda x: x["x"]), "\n")
    )
    if not report:
        return found.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
    added = {
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_dropped": F.coalesce(F.size("__dropped"), F.lit(0)).cast("long"),
        "dropped": F.coalesce("__dropped", F.array().cast("array<int>")),
    }
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text" and c not in added]
    return found.select(*others, text.alias("text"), *[x.alias(c) for c, x in added.items()])
