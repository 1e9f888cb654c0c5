"""Packing documents into token sequences by first-fit decreasing.

A document's ids (its tokens and a final id) are cut into pieces of at most
``SEQUENCE`` (4096); full pieces are sequences by themselves.  The other pieces
are dealt at random into groups of about ``GROUP_PIECES``, and each group is
packed by itself: longest piece first, into the first sequence with room, which
a tournament tree over the sequences' free room finds in a logarithm of steps.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

SEQUENCE = 4096
END_ID = 2
GROUP_PIECES = 2000
SEED = 7
CACHED_WORDS = 500_000  # words, and parts of words, whose ids a worker keeps

_encoders: dict[str, WordEncoder] = {}


def tokenizer_path() -> str:
    """Place of the default vocabulary file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Kept(dict):
    """What ``make`` gave for each key so far, for ``CACHED_WORDS`` keys at most."""

    def __init__(self, make: Callable[[str | bytes], bytes]) -> None:
        self.make = make

    def __missing__(self, key: str | bytes) -> bytes:
        made = self.make(key)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[key] = made
        return made


class WordEncoder:
    """Ids of words by a tokenizer that lower-cases, drops white space and never joins characters over it.

    Words and their parts (what the tokenizer's own splitting leaves) are looked
    up once known, so an unseen word of seen parts costs no merging.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.normalizer, self.splitter = self.whole.normalizer, self.whole.pre_tokenizer
        self.model = self.whole.model
        self.marks = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        # Latin letters that stay one letter in lower case, and how the tokenizer writes each.
        latin = [c for c in map(chr, range(0x250)) if c.isalpha() and c.lower().isalpha()]
        self.written = {ord(c): self.splitter.pre_tokenize_str(c)[0][0] for c in latin if not c.isascii()}
        self.plain = re.compile(f"([{''.join(latin)}]+)([.,;:!?]*)")
        self.words, self.parts = _Kept(self._word), _Kept(self._part)

    def _part(self, part: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        plain = self.plain.fullmatch(text)
        if plain:  # letters are a part, and the signs after them another
            letters, signs = plain.groups()
            found = self.parts[letters.lower().translate(self.written)]
            return found + self.parts[signs] if signs else found
        if any(m in text for m in self.marks):  # cut out by the tokenizer before anything else
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        split = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return b"".join([self.parts[p] for p, _ in split])

    def encode(self, text: bytes) -> bytes:
        """The ids of a UTF-8 text as little-endian 32-bit numbers."""
        return b"".join(map(self.words.__getitem__, text.split()))


def encode_texts(texts: list[bytes], path: str | None = None) -> list[bytes]:
    """The ids of each UTF-8 text as little-endian 32-bit numbers, by the vocabulary file at ``path``."""
    path = path or tokenizer_path()
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return [_encoders[path].encode(t) for t in texts]


def token_pieces(docs: DataFrame, *, path: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens)`` for each piece of each document."""
    slim = docs.select(
        F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("t")
    )
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):  # few texts at a time, however long
                batch = whole.slice(at, 64)
                rows, starts, lengths, crcs, totals = [], [], [], [], []
                for i, ids in enumerate(encode_texts(batch.column(1).to_pylist(), path)):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, sequence):
                        piece = ids[4 * start : 4 * (start + sequence)]
                        rows.append(i)
                        starts.append(start)
                        lengths.append(len(piece) // 4)
                        crcs.append(zlib.crc32(piece))
                        totals.append(total)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64()))]
                    + [pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return slim.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, packed longest first into the first bin with room."""
    order = np.argsort(-lengths, kind="stable")
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    # Node i has the larger free room of its children 2i and 2i + 1; leaves are bins from left to right.
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in order.tolist():
        size = int(lengths[i])
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def pack(docs: DataFrame, *, path: str | None = None, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    NULL and empty texts are one piece, the final id; repeated rows are packed
    each; a NULL doc_id is a document like others; other columns are ignored; an
    empty table gives no rows.  The same rows in the same files give the same packing.
    """
    pieces = staged(token_pieces(docs, path=path, sequence=sequence), "pieces")
    pieces = pieces.withColumn("__at", F.monotonically_increasing_id())
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = pieces.where(F.col("length") == sequence).select(
        *columns, (F.col("__at") + (1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.where(F.col("length") < sequence)
    groups = max(1, -(-rest.count() // group_pieces))
    rest = rest.withColumn("__group", F.pmod(F.xxhash64(F.lit(SEED), "__at"), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__at", kind="stable").reset_index(drop=True)
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), sequence)
        pdf["sequence_id"] = pdf["__group"] * (1 << 32) + bins
        pdf["offset"] = offsets
        return pdf[["__at", "sequence_id", "offset"]]

    # doc_id stays out of pandas, where a NULL would turn ids into floats.
    placed = rest.select("__at", "length", "__group").groupBy("__group").applyInPandas(
        run, "__at long, sequence_id long, offset long"
    )
    return full.union(rest.join(placed, "__at").select(*columns, "sequence_id", "offset"))


def padded_length(tokens: int, sequence: int = SEQUENCE) -> int:
    """Length a sequence of so many tokens is stored with: ``sequence``, or its own if a power of two."""
    return tokens if tokens & (tokens - 1) == 0 else sequence
