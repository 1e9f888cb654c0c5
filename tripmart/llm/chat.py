"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole:  ``<|im_start|>role<|im_sep|>text<|im_end|>``
for each turn.  The three marks are special tokens; inside roles and texts every
``<`` that would begin a ``<|`` gets a backslash after it (and one more if it has
some already), which can be undone.  The rendered string is encoded once, with
offsets.  Turn spans and token spans are both sorted, so the tokens under an
assistant text are found by binary search.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LOSS_ROLE = "assistant"

_tokenizers: dict[str, object] = {}
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"(.*?)" + re.escape(SEP) + r"(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    """No ``<|`` is left; ``unescape`` gives the text back."""
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _encoder(path: str | None):
    path = path or tokenizer_path()
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        tokenizer = Tokenizer.from_file(path)
        # The vocabulary's own marks are ordinary text here; ours are cut out before the text is split.
        tokenizer.add_tokens([AddedToken(m, normalized=False, special=False) for m in (START, SEP, END)])
        tokenizer.encode_special_tokens = True
        _tokenizers[path] = tokenizer
    return _tokenizers[path]


@dataclass
class Rendered:
    text: str
    ids: list[int]
    offsets: list[tuple[int, int]]  # of each id, in code points
    mask: list[bool]  # of each id: does it carry loss


def render(turns: list[tuple[str, str]], path: str | None = None) -> Rendered:
    """Format, encode and mask one conversation of (role, text) turns."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEP, escape(text)
        parts += [head, body, END]
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    text = "".join(parts)
    coded = _encoder(path).encode(text, add_special_tokens=False)
    offsets = coded.offsets
    starts, ends = [s for s, _ in offsets], [e for _, e in offsets]
    mask = [False] * len(offsets)
    for s, e in spans:
        if s < e:
            # Tokens that end after the span's start and begin before its end.
            first, stop = bisect_right(ends, s), bisect_left(starts, e)
            mask[first:stop] = [True] * (stop - first)
    return Rendered(text, coded.ids, offsets, mask)


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def masked_text(out: Rendered) -> str:
    """The text under the loss mask, unescaped, turn by turn."""
    pieces, start, end = [], None, None
    for (s, e), loss in zip(out.offsets, out.mask, strict=True):
        if loss and start is not None and s <= end:
            end = max(end, e)
        else:
            if start is not None:
                pieces.append(unescape(out.text[start:end]))
                start = None
            if loss:
                start, end = s, e
    if start is not None:
        pieces.append(unescape(out.text[start:end]))
    return "".join(pieces)


def conversations(rows: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: each conversation's (turn, role, text) rows in order of turn, role and text.

    A conversation is one record, as its formatted text is.  NULL turns come
    first, NULL roles and texts are empty.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def format_conversations(rows: DataFrame, *, path: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, formatted, ids, loss (0/1 per id), loss_text.

    Repeated rows are turns of their own; a NULL conv_id is one conversation;
    empty assistant texts carry no loss; other columns are ignored; an empty
    table gives no rows.
    """
    grouped = conversations(rows).select(
        "conv_id",
        F.transform("turns", lambda x: x["role"]).alias("roles"),
        F.transform("turns", lambda x: x["text"]).alias("texts"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                outs = [
                    render(list(zip(r, t, strict=True)), path)
                    for r, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([o.text for o in outs], pa.string()),
                        pa.array([o.ids for o in outs], pa.list_(pa.int32())),
                        pa.array([list(map(int, o.mask)) for o in outs], pa.list_(pa.int8())),
                        pa.array([masked_text(o) for o in outs], pa.string()),
                    ],
                    names=["conv_id", "formatted", "ids", "loss", "loss_text"],
                )

    kind = dict(rows.dtypes)["conv_id"]
    return grouped.mapInArrow(
        run, f"conv_id {kind}, formatted string, ids array<int>, loss array<tinyint>, loss_text string"
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per formatted conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    kind = dict(formatted.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = [turns_of(x.as_py()) for x in batch.column(1)]
            digests = [hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in x).encode()).hexdigest() for x in turns]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in turns], pa.int64()), pa.array(digests, pa.string())]
                + [batch.column(i) for i in (2, 3, 4, 5, 6)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"],
            )

    slim = formatted.select(
        "conv_id",
        "formatted",
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.size(F.filter("loss", lambda x: x == 1)).cast("long").alias("n_loss_tokens"),
    )
    return slim.mapInArrow(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "n_tokens long, n_loss_tokens long",
    )
