"""License scan by canonical digest lookup, in DataFrame expressions only.

Texts are brought to one form: lower case, no copyright lines, equivalent
spellings made equal, white space and punctuation dropped.  The digest of the
form is joined with the digests of known licences.  Entire documents are looked
up, and so is each line, since licence notices stand as lines of their own.

The table of known licences has a fixed number of rows (``ALL_KNOWN``), which is
why it is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged
from .license_texts import headings, texts, whole_texts

# Canonical names and texts of known licences and licence notices.
MIT_TEXT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
ISC_TEXT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
KNOWN: list[tuple[str, str]] = [
    ("MIT", MIT_TEXT),
    ("MIT", "MIT License\n" + MIT_TEXT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", ISC_TEXT),
    ("ISC", "ISC License\n" + ISC_TEXT),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
]
ALL_KNOWN = KNOWN + whole_texts(MIT_TEXT, ISC_TEXT)

# Spellings that mean the same, after lower-casing.
SPELLINGS: list[tuple[str, str]] = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("organisation", "organization"),
    ("https://", "http://"),
    ("(c)", "©"),
]
COPYRIGHT_LINE = r"^[^\p{L}\p{N}\n]*(copyright|©|\(c\))[^\n]*([0-9]{4}|all rights reserved)[^\n]*$"
# Lines without a year.  A bare (c) begins one only where it is not the third item after (a) and (b).
YEARLESS_LINE = r"^[^\p{L}\p{N}\n]*(copyright[\x20\t]*(©|\(c\))|©)[^\n]*$"
BARE_LINE = r"^[^\p{L}\p{N}\n]*\(c\)[^\n]*$"
NOISE = r"[^\p{L}\p{N}©]+"


def canonical_lines(text: Column) -> Column:
    """The normal form of each line of a text; NULL counts as empty.

    Every step stays within a line, so the form of the whole text is the forms
    joined; only whether a bare (c) is a list item is asked of the whole text.
    """

    def form(*dropped: str) -> Callable[[Column], Column]:
        def one(line: Column) -> Column:
            same = reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), SPELLINGS, line)
            drop = reduce(lambda a, b: a | b, [line.rlike(x) for x in dropped])
            return F.when(drop, "").otherwise(F.regexp_replace(same, NOISE, ""))

        return one

    low = F.lower(F.coalesce(text, F.lit("")))
    lines = F.split(low, "\n")
    listed = F.transform(lines, form(COPYRIGHT_LINE, YEARLESS_LINE))
    return F.when(F.contains(low, F.lit("(b)")), listed).otherwise(
        F.transform(lines, form(COPYRIGHT_LINE, YEARLESS_LINE, BARE_LINE))
    )


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = ALL_KNOWN) -> DataFrame:
    """``(digest, license, form_length)`` of the known texts, one row per digest; empty forms are left out."""
    rows = spark.createDataFrame(known, "license string, text string")
    forms = rows.select("license", F.array_join(canonical_lines(F.col("text")), "").alias("form")).where("form <> ''")
    return forms.groupBy(F.sha2("form", 256).alias("digest"), F.length("form").alias("form_length")).agg(
        F.min("license").alias("license")
    )


def scan_licenses(docs: DataFrame, *, known: list[tuple[str, str]] = ALL_KNOWN) -> DataFrame:
    """One row per document: doc_id, digest, whole_license, n_license_lines and licenses.

    ``digest`` is that of the entire text's form; ``whole_license`` the licence
    it is (or NULL); ``n_license_lines`` counts the lines that are known by
    themselves and ``licenses`` lists what text or lines name, sorted and
    comma-joined.  A NULL or empty text names nothing; repeated rows get the
    same result each; a NULL doc_id is a document like others; other columns
    are ignored; an empty table gives no rows.
    """
    rows = known_digests(docs.sparkSession, known).collect()  # len(known) at most
    table = docs.sparkSession.createDataFrame(rows, "digest string, form_length int, license string")
    lengths = sorted({r["form_length"] for r in rows})
    slim = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), canonical_lines(F.col("text")).alias("lines")
    )
    slim = slim.withColumn("whole", F.array_join("lines", ""))
    marked = staged(
        slim.select(
            "doc_id",
            "th",
            F.sha2("whole", 256).alias("digest"),
            # A form of another length than every known one cannot be equal to any.
            F.transform(F.filter("lines", lambda x: F.length(x).isin(lengths)), lambda x: F.sha2(x, 256)).alias("line_digests"),
        ),
        "license-digests",
    )
    by_digest = F.broadcast(table.select("digest", "license"))  # a row per known text: len(known) at most
    lines = marked.distinct().select("doc_id", "th", F.posexplode("line_digests").alias("pos", "digest"))
    found = lines.join(by_digest, "digest").groupBy(F.struct("doc_id").alias("key"), "th").agg(
        F.count("*").alias("n"), F.collect_set("license").alias("names")
    )
    whole = by_digest.select("digest", F.col("license").alias("whole_license"))
    out = marked.withColumn("key", F.struct("doc_id")).join(whole, "digest", "left").join(found, ["key", "th"], "left")
    own = F.when(F.col("whole_license").isNull(), F.array().cast("array<string>")).otherwise(F.array("whole_license"))
    names = F.array_sort(F.array_union(own, F.coalesce("names", F.array().cast("array<string>"))))
    return out.select(
        "doc_id",
        "digest",
        "whole_license",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_license_lines"),
        F.array_join(names, ",").alias("licenses"),
    )


def _values(rows: list[tuple[str, str]]) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return "(VALUES " + ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in rows) + ")"


def _oracle() -> str:
    same = "l"
    for a, b in SPELLINGS:
        same = f"replace({same}, '{a}', '{b}')"
    kept = f"regexp_replace({same}, '{NOISE}', '', 'g')"
    listed = "contains(low, '(b)')"
    dropped = " OR ".join(f"regexp_matches(l, '{x}')" for x in (COPYRIGHT_LINE, YEARLESS_LINE))
    dropped += f" OR (NOT {listed} AND regexp_matches(l, '{BARE_LINE}'))"
    form = f"CASE WHEN {dropped} THEN '' ELSE {kept} END"
    return f"""
WITH k AS (
    SELECT license, list_transform(string_split(low, chr(10)), lambda l: {form}) AS ls
    FROM (
        SELECT license, lower(t) AS low FROM {_values(KNOWN)} v(license, t)
        UNION ALL SELECT license, lower(coalesce(h, '') || t)
        FROM {_values(texts(MIT_TEXT, ISC_TEXT))} v(license, t) LEFT JOIN {_values(headings())} w(license, h) USING (license)
    )
), known AS (
    SELECT sha256(array_to_string(ls, '')) AS digest, min(license) AS license FROM k
    WHERE array_to_string(ls, '') <> '' GROUP BY 1
), d AS (
    SELECT row_number() OVER () AS r, doc_id,
        list_transform(string_split(low, chr(10)), lambda l: {form}) AS ls
    FROM (SELECT doc_id, lower(coalesce(text, '')) AS low FROM documents)
), w AS (
    SELECT r, doc_id, digest, license AS whole_license
    FROM (SELECT r, doc_id, sha256(array_to_string(ls, '')) AS digest FROM d) LEFT JOIN known USING (digest)
), one AS (
    SELECT r, license FROM (SELECT r, unnest(ls) AS l FROM d) JOIN known ON sha256(l) = digest
    WHERE l <> ''
)
SELECT doc_id, digest, whole_license, coalesce(n, 0) AS n_license_lines, coalesce(names, '') AS licenses
FROM w LEFT JOIN (SELECT r, count(*) AS n FROM one GROUP BY r) USING (r)
LEFT JOIN (
    SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS names
    FROM (SELECT r, license FROM one UNION ALL SELECT r, whole_license FROM w WHERE whole_license IS NOT NULL) GROUP BY r
) USING (r)
"""


ORACLE = _oracle()
