"""Whole texts of common licences in their usual forms, as ``(license, text)`` rows.

The long ones lie beside this file as published.  A licence's text does not say
whether later versions may be used, so GNU ones are named without "only".
"""

from __future__ import annotations

from itertools import product
from pathlib import Path

_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:"
)
_SOURCE = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer."
)
_BINARY = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution."
)
_NAMES = (
    "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission."
)
_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT\n{} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GRANT = "Permission to use, copy, modify, {} distribute this software for any purpose with or without fee is hereby granted"
_KEEP = "The above copyright notice and this permission notice{} shall be included in all copies or substantial portions of the Software.\n"
_HOLDERS = ("the copyright holder", "the copyright owner", "copyright holder", "the author", "the organization", "the <organization>")

# What may stand above a text; a copyright line between the two is dropped anyway.
_RESERVED = ("", "All rights reserved.\n")
_TITLES = {
    "MIT": ("", "MIT License\n", "The MIT License (MIT)\n", "The MIT License\n", "MIT License (MIT)\n", "# MIT License\n"),
    "MIT-0": ("", "MIT No Attribution\n", "MIT No Attribution License\n", "MIT-0\n"),
    "ISC": ("", "ISC License\n", "The ISC License\n", "ISC License (ISC)\n", "ISC License (ISCL)\n"),
    "0BSD": ("", "Zero-Clause BSD\n", "BSD Zero Clause License\n", "Zero-Clause BSD (0BSD)\n", "0BSD\n"),
    "BSD-2-Clause": ("", "BSD 2-Clause License\n", "The BSD 2-Clause License\n", 'BSD 2-Clause "Simplified" License\n', "Simplified BSD License\n"),
    "BSD-3-Clause": ("", "BSD 3-Clause License\n", "The BSD 3-Clause License\n", 'BSD 3-Clause "New" or "Revised" License\n', "New BSD License\n"),
    "Zlib": ("", "zlib License\n", "The zlib License\n", "zlib/libpng license\n"),
    "Unlicense": ("", "The Unlicense\n", "Unlicense\n"),
}


def _bsd(clauses: list[str], word: str, marked: bool) -> str:
    listed = [f"{n}. {c}" if marked else f"* {c}" for n, c in enumerate(clauses, 1)]
    return "\n".join([_CONDITIONS, *listed, _DISCLAIMER.format(word)])


def _published() -> list[tuple[str, str]]:
    """The files, each also without what follows its terms (how to apply them)."""
    rows = []
    for path in sorted(Path(__file__).parent.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        rows.append((path.stem, text))
        end = text.find("END OF TERMS AND CONDITIONS")
        if end >= 0:
            rows += [(path.stem, text[:end]), (path.stem, text[:end] + "END OF TERMS AND CONDITIONS")]
            # A filled-in notice is a copyright line, which is dropped.
            rows.append((path.stem, text.replace("Copyright [yyyy] [name of copyright owner]", "")))
        if path.stem == "Unlicense":  # its last line was http once
            rows.append((path.stem, text[: text.rindex("For more information")]))
    return rows


def headings() -> list[tuple[str, str]]:
    """``(license, heading)``: what may stand above the texts of a licence."""
    return [(n, t + r) for n, titles in _TITLES.items() for t, r in product(titles, _RESERVED)]


def texts(mit: str, isc: str) -> list[tuple[str, str]]:
    """``(license, text)`` without headings, given the plain MIT and ISC texts."""
    bodies = [("MIT", mit), ("ISC", isc), ("ISC", isc.replace("and/or distribute", "and distribute"))]
    head, rest = mit.split("subject to the following conditions:\n")
    keep, disclaimer = rest.split("\n", 1)
    next_one = _KEEP.format(" (including the next paragraph)")
    bodies.append(("MIT", f"{head}subject to the following conditions:\n{next_one}{disclaimer}"))
    bodies.append(("MIT-0", head.rstrip(", ") + ".\n" + disclaimer))
    bodies += [("0BSD", _GRANT.format(a) + ".\n" + isc.split("\n", 1)[1]) for a in ("and/or", "and")]
    for word, marked in product(("HOLDER", "OWNER"), (True, False)):
        bodies.append(("BSD-2-Clause", _bsd([_SOURCE, _BINARY], word, marked)))
        bodies += [("BSD-3-Clause", _bsd([_SOURCE, _BINARY, _NAMES.format(x)], word, marked)) for x in _HOLDERS]
    return bodies + _published()


def whole_texts(mit: str, isc: str) -> list[tuple[str, str]]:
    """Each text under each of its licence's headings; one of a licence without headings as it is."""
    above: dict[str, list[str]] = {}
    for name, heading in headings():
        above.setdefault(name, []).append(heading)
    return [(n, h + t) for n, t in texts(mit, isc) for h in above.get(n, [""])]
