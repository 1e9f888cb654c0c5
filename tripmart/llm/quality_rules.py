"""Quality rules with host verdicts, in DataFrame expressions only.

Every document is measured and tested against per-document rules.  Failures are
added up by host (``source``), each rule's failure rate is shrunk towards the
corpus with a beta prior fitted to the hosts by the method of moments, and a
host whose shrunk rate reaches ``HOST_LIMIT`` in any rule is rejected with all
its documents.  Hosts without a name have no verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, staged, words, zip_shifted

MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PCT = 20
MAX_SYMBOL_PCT = 10  # symbols per 100 words
MAX_DUP_LINE_PCT = 30  # repeated lines per 100 lines with a word
MIN_MEAN_WORD, MAX_MEAN_WORD = 2, 20  # code points
HOST_LIMIT = 0.6  # a shrunk failure rate that condemns a host

# Rules that fail a document by itself, and rules that only count for its host.
BASE_RULES = ("few_words", "repeated_words")
HOST_RULES = (*BASE_RULES, "symbols", "repeated_lines", "word_length")


def _with_windows(df: DataFrame) -> DataFrame:
    """``df`` with ``__h``: a hash of each run of REPEAT_WINDOW (5) words of ``__w``, in order.

    Built from shifted copies of the array, never by indexing it inside a
    lambda, which would evaluate the array again for every element.  Each step
    uses the one before it several times and so is a projection of its own.
    """

    def pair(a: Column, b: Column) -> Column:
        return F.xxhash64(a, b)

    df = df.withColumn("__two", zip_shifted(F.col("__w"), F.col("__w"), 1, pair))
    df = df.withColumn("__four", zip_shifted(F.col("__two"), F.col("__two"), 2, pair))
    return df.withColumn("__h", zip_shifted(F.col("__four"), F.col("__w"), 4, pair)).drop("__two", "__four")


def _covered(order: Column) -> Column:
    """Words inside windows that occur twice or more; ``order`` holds (hash, start), sorted."""
    pairs = zip_shifted(
        order, order, 1, lambda p, x: F.when(p["h"] == x["h"], F.array(p["i"], x["i"])).otherwise(F.array().cast("array<int>"))
    )
    at = F.array_sort(F.array_distinct(F.flatten(pairs)))
    # Each window adds what the one before it has not covered.
    return F.aggregate(
        at,
        F.struct(F.lit(0).alias("n"), F.lit(-REPEAT_WINDOW).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(REPEAT_WINDOW), i - acc["last"])).alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words.

    Words are runs of anything but white space; lines are split at newlines and
    count when they hold a word; a NULL text measures as an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # One projection per step, so that each array is built once.
    df = docs.withColumns(
        {"__w": words(F.col("text")), "__l": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))}
    )
    df = _with_windows(df)
    df = df.withColumns({"__u": F.size(F.array_distinct("__h"))})
    order = F.array_sort(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumns({"__o": F.when(F.col("__u") < F.size("__h"), order)})
    repeats = F.when(F.col("__o").isNotNull(), _covered(F.col("__o"))).otherwise(0)
    return df.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(F.array_join("__w", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_lines": F.size("__l").cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
            "n_repeat_words": repeats.cast("long"),
        }
    ).drop("__w", "__l", "__h", "__u", "__o")


def rule_failures() -> dict[str, Column]:
    """Rule name → whether a measured document fails it (never NULL)."""
    n = F.col("n_words")
    return {
        "few_words": n < MIN_WORDS,
        "repeated_words": 100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * n,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PCT * n,
        "repeated_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PCT * F.col("n_lines"),
        "word_length": (F.col("word_chars") < MIN_MEAN_WORD * n) | (F.col("word_chars") > MAX_MEAN_WORD * n),
    }


def host_verdicts(measured: DataFrame) -> DataFrame:
    """``(host, rule rates…, host_rejected)`` for each non-NULL source of measured documents.

    With rates r_h over n_h documents, mean m and variance v of the rates over
    hosts, the prior is Beta(m s, (1 - m) s), s = m (1 - m) / v - 1, kept
    between 1 and 1000; the shrunk rate is (failures + m s) / (n + s).
    """
    fails = rule_failures()
    hosts = measured.where(F.col("source").isNotNull()).groupBy(F.col("source").alias("host")).agg(
        F.count("*").alias("n"), *[F.count_if(fails[r]).alias(r) for r in HOST_RULES]
    )
    hosts = staged(hosts, "hosts")
    row = hosts.agg(
        *[F.avg(F.col(r) / F.col("n")).alias(f"{r}_m") for r in HOST_RULES],
        *[F.coalesce(F.var_pop(F.col(r) / F.col("n")), F.lit(0.0)).alias(f"{r}_v") for r in HOST_RULES],
    ).first()
    rates = {}
    for r in HOST_RULES:
        m, v = row[f"{r}_m"] or 0.0, row[f"{r}_v"]
        strength = min(1000.0, max(1.0, m * (1 - m) / v - 1)) if v > 0 else 1000.0
        rates[r] = (F.col(r) + F.lit(m * strength)) / (F.col("n") + F.lit(strength))
    bad = F.lit(False)
    for r in HOST_RULES:
        bad = bad | (rates[r] >= HOST_LIMIT)
    return hosts.select("host", *[rates[r].alias(f"{r}_rate") for r in HOST_RULES], bad.alias("host_rejected"))


def quality_verdicts(docs: DataFrame, *, id_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: its id columns, the measures, base_failed, host_rejected and kept.

    A NULL or empty text has no words and fails; a NULL source is never a host;
    repeated rows are measured and counted each; other columns are ignored; an
    empty table gives no rows.
    """
    keys = [F.col(c).alias(f"__id{i}") for i, c in enumerate(id_cols)]
    slim = measures(docs.select(*keys, "source", "text")).drop("text")
    # The measures are needed twice (host totals, output) and are small: written once.
    measured = staged(slim, "quality")
    fails = rule_failures()
    base = fails["few_words"] | fails["repeated_words"]
    hosts = host_verdicts(measured).select("host", "host_rejected")
    joined = measured.join(hosts, measured.source == hosts.host, "left")
    rejected = F.coalesce(F.col("host_rejected"), F.lit(False))
    return joined.select(
        *[F.col(f"__id{i}").alias(c) for i, c in enumerate(id_cols)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), rejected.alias("host_rejected"), (~base & ~rejected).alias("kept"),
    )


def keep_good_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass their base rules and whose host is not rejected; columns of ``docs``.

    The rows are measured once and written with their measures; only the
    totals by host are joined back to them.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    measured = staged(measures(docs.select(row, "source", "text")).drop("text"), "quality-rows")
    hosts = host_verdicts(measured).where("host_rejected").select("host")
    fails = rule_failures()
    good = measured.where(~(fails["few_words"] | fails["repeated_words"]))
    return good.join(hosts, good.source == hosts.host, "left_anti").select("__row.*")


ORACLE = rf"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents
), w AS (
    SELECT *, list_filter(regexp_split_to_array(t, '{SPACE}+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM d
), one AS (
    SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w
), win AS (
    SELECT r, i, {", ".join(f"lead(x, {j}) OVER o AS x{j}" for j in range(REPEAT_WINDOW))}
    FROM one WINDOW o AS (PARTITION BY r ORDER BY i)
), hit AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, {", ".join(f"x{j}" for j in range(REPEAT_WINDOW))}) AS c
    FROM win WHERE x{REPEAT_WINDOW - 1} IS NOT NULL
), rep AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest(range(i, i + {REPEAT_WINDOW})) AS p FROM hit WHERE c > 1) GROUP BY r
), m AS (
    SELECT w.r, doc_id, source, len(ws) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM w LEFT JOIN rep ON w.r = rep.r
), f AS (
    SELECT *, n_words < {MIN_WORDS} AS few_words,
        100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS repeated_words,
        100 * n_symbols > {MAX_SYMBOL_PCT} * n_words AS symbols,
        100 * n_dup_lines > {MAX_DUP_LINE_PCT} * n_lines AS repeated_lines,
        word_chars < {MIN_MEAN_WORD} * n_words OR word_chars > {MAX_MEAN_WORD} * n_words AS word_length
    FROM m
), h AS (
    SELECT source AS host, count(*) AS n, unnest([{", ".join(f"'{r}'" for r in HOST_RULES)}]) AS rule,
        unnest([{", ".join(f"count(*) FILTER ({r})" for r in HOST_RULES)}]) AS failed
    FROM f WHERE source IS NOT NULL GROUP BY source
), p AS (
    SELECT rule, avg(failed / n) AS mu, var_pop(failed / n) AS v FROM h GROUP BY rule
), s AS (
    SELECT rule, mu, CASE WHEN v > 0 THEN least(1000.0, greatest(1.0, mu * (1 - mu) / v - 1)) ELSE 1000.0 END AS k FROM p
), bad AS (
    SELECT DISTINCT host FROM h JOIN s USING (rule) WHERE (failed + mu * k) / (n + k) >= {HOST_LIMIT}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    few_words OR repeated_words AS base_failed, host IS NOT NULL AS host_rejected,
    NOT (few_words OR repeated_words) AND host IS NULL AS kept
FROM f LEFT JOIN bad ON source = host
"""
