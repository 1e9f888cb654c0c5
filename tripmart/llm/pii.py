"""Personal data with offset-preserving deobfuscation.

Identifiers are first found in the text as it stands (the base).  Then a chain of
small transducers rewrites the text: look-alike characters to ASCII, spelled
digits to digits, disguised ``at`` and ``dot`` to @ and a dot.  Every rewritten
character remembers the source span it came from, so identifiers found in the
rewritten text are mapped back to source characters and added to the base.

A span is ``(kind, start, end)`` in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits is taken whole, so each pattern may start at its first digit only.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Goes from @ to @, so that long runs without one cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def detect(text: str) -> list[Span]:
    """Leftmost non-overlapping identifiers of each kind, by kind and start."""
    found: list[Span] = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text) if "." in text else ():
        parts = [x.lstrip("0") or "0" for x in m[0].split(".")]
        if all(len(x) <= 3 and int(x) <= 255 for x in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


# Letters that look like ASCII ones (Cyrillic, Greek), other digits and signs, one character each.
_LOOKALIKES = dict(
    zip(
        "аеорсухікјѕԁԛԝһгАВЕКМНОРСТХІЈЅοαρνικυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxikjsdqwhrABEKMHOPCTXIJSoapvikuABEZHIKMNOPTYX",
        strict=True,
    )
)
_LOOKALIKES |= {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}  # full-width forms
_LOOKALIKES |= {chr(base + d): str(d) for base in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7E2) for d in range(10)}
_LOOKALIKES |= {"。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", " ": " "}
_TABLE = str.maketrans(_LOOKALIKES)
_ODD = re.compile("[" + "".join(map(re.escape, _LOOKALIKES)) + "]")
_HIDDEN = re.compile("[​‌‍⁠﻿­]+")

_DIGITS = {w: str(d) for d, ws in enumerate("zero,one,two,three,four,five,six,seven,eight,nine".split(",")) for w in [ws]}
_DIGITS["oh"] = "0"
_WORD = "(?:" + "|".join(_DIGITS) + ")"
# Spelled digits count beside one another, a numeral or a plus; "dot" or "point" between belong to a run.  What parts
# them is dropped; the detectors' own checks (a plus and 9 digits, Luhn, four parts) tell identifiers from counting.
_ONE = rf"(?<![^\W_]){_WORD}(?![^\W_])"
_GAP = r"[ ,()-]++(?:(?:dot|point)[ ,-]++)?"
_LEAD = rf"(?:(?<![^\W_])plus[ -]++|(?<=[0-9]){_GAP}|(?<=\+)[ (]*+)"
_TRAIL = rf"{_GAP}(?=[0-9])"
_SPELLED = re.compile(
    rf"{_LEAD}{_ONE}(?:{_GAP}{_ONE})*(?:{_TRAIL})?|{_ONE}(?:(?:{_GAP}{_ONE})+(?:{_TRAIL})?|{_TRAIL})", re.IGNORECASE
)
_PART = re.compile(rf"plus|dot|point|{_WORD}", re.IGNORECASE)
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
# Spaces are taken from the start of their run and never given back, so that a long run is read once.
_AT = re.compile(
    rf"(?<! )[ ]*+{_OPEN}[ ]*+(?:at|@)[ ]*+{_CLOSE}[ ]*+"
    rf"|(?<! )[ ]++at[ ]++(?=[A-Za-z0-9-]++(?:[ ]++dot[ ]++|[ ]*+{_OPEN}[ ]*+dot[ ]*+{_CLOSE}[ ]*+)[A-Za-z])",
    re.IGNORECASE,
)
_DOT = re.compile(rf"(?<! )[ ]*+{_OPEN}[ ]*+(?:dot|\.)[ ]*+{_CLOSE}[ ]*+", re.IGNORECASE)
_BARE_DOT = re.compile(r"[ ]++dot[ ]++(?=[A-Za-z0-9])", re.IGNORECASE)
_SPELLED_DOMAIN = re.compile(rf"@[A-Za-z0-9.-]*+(?:{_BARE_DOT.pattern}[A-Za-z0-9.-]*+)+", re.IGNORECASE)
_WORD_DOT = re.compile(r"(?<=[A-Za-z0-9_%+-])[ ]+dot[ ]+(?=[A-Za-z0-9_%+-])", re.IGNORECASE)
_RUN = re.compile(r"[A-Za-z0-9._%+-]++")


class Tape:
    """A text with, for each character, the source span it stands for."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts = list(range(len(text)))
        self.ends = list(range(1, len(text) + 1))

    def rewrite(self, pattern: re.Pattern, write: Callable[[re.Match], list[tuple[str, int, int]]]) -> bool:
        """Replace each match by ``write``'s (character, from, to) triples; True if there was one."""
        chars, starts, ends, last = [], [], [], 0
        for m in pattern.finditer(self.text):
            chars.append(self.text[last : m.start()])
            starts += self.starts[last : m.start()]
            ends += self.ends[last : m.start()]
            for c, s, e in write(m):
                chars.append(c)
                starts.append(self.starts[s])
                ends.append(self.ends[e - 1])
            last = m.end()
        if not last:
            return False
        self.text = "".join(chars) + self.text[last:]
        self.starts, self.ends = starts + self.starts[last:], ends + self.ends[last:]
        return True

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def _spelled(m: re.Match) -> list[tuple[str, int, int]]:
    sign = {"plus": "+", "dot": ".", "point": "."}
    base = m.start()
    return [
        (sign.get(p[0].lower()) or _DIGITS[p[0].lower()], base + p.start(), base + p.end()) for p in _PART.finditer(m[0])
    ]


def _dots_before_at(text: str) -> set[int]:
    """Where a spelled dot begins that only local parts and such dots part from an @."""
    found: set[int] = set()
    for m in reversed(list(_WORD_DOT.finditer(text))):
        end = _RUN.match(text, m.end()).end()
        if text.startswith("@", end) or end in found:
            found.add(m.start())
    return found


def _dotted(m: re.Match) -> list[tuple[str, int, int]]:
    """A domain behind its @ with each spelled dot written as one."""
    out, last = [], m.start()
    for d in _BARE_DOT.finditer(m.string, m.start(), m.end()):
        out += [(m.string[i], i, i + 1) for i in range(last, d.start())] + [(".", *d.span())]
        last = d.end()
    return out + [(m.string[i], i, i + 1) for i in range(last, m.end())]


def deobfuscate(text: str) -> Tape | None:
    """The rewritten text, or None if nothing in it is disguised."""
    odd, hidden = not text.isascii() and _ODD.search(text), not text.isascii() and _HIDDEN.search(text)
    low = text.lower()
    bare = odd or hidden
    spelled = bare or _SPELLED.search(text)
    marked = bare or "dot" in low or _AT.search(text) or _DOT.search(text)
    if not (odd or hidden or spelled or marked):
        return None
    tape = Tape(text.translate(_TABLE) if odd else text)  # one character for one
    changed = bool(odd)
    if hidden:
        changed |= tape.rewrite(_HIDDEN, lambda m: [])
    changed |= tape.rewrite(_SPELLED, _spelled)
    changed |= tape.rewrite(_AT, lambda m: [("@", m.start(), m.end())])
    changed |= tape.rewrite(_DOT, lambda m: [(".", m.start(), m.end())])
    dots = _dots_before_at(tape.text) if "@" in tape.text else set()
    if dots:
        changed |= tape.rewrite(
            _WORD_DOT,
            lambda m: [(".", *m.span())] if m.start() in dots else [(c, i, i + 1) for i, c in enumerate(m[0], m.start())],
        )
    if "@" in tape.text:
        changed |= tape.rewrite(_SPELLED_DOMAIN, _dotted)
    return tape if changed else None


def find(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans and all spans, each by kind as listed, then start."""
    base = detect(text)
    spans = list(base)
    tape = deobfuscate(text)
    if tape is not None:
        # A span that cuts through a base one is left out; one that holds base ones whole, and more, is added.
        taken = {k: [(a, b) for kind, a, b in base if kind == k] for k in KINDS}
        for kind, s, e in detect(tape.text):
            start, end = tape.source(s, e)
            own = taken[kind]  # sorted and apart
            first, last = bisect_right(own, start, key=lambda x: x[1]), bisect_left(own, end, key=lambda x: x[0])
            met = own[first:last]
            if not met or (met[0][0] >= start and met[-1][1] <= end and met != [(start, end)]):
                spans.append((kind, start, end))
        spans.sort(key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
    return base, spans


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans, n_added.

    A NULL text counts as empty and has no spans; repeated rows are scanned
    each; a NULL doc_id is a document like others; other columns are ignored;
    an empty table gives no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans, added = [], [], []
            for value in batch.column(1):
                base, every = find(value.as_py())
                for i, k in enumerate(KINDS):
                    counts[i].append(sum(x[0] == k for x in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(every))
                added.append(len(every) - len(base))
            columns = [pa.array(c, pa.int64()) for c in counts]
            columns += [pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
            )

    schema = f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)
