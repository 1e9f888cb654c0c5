"""Spelling variants: exact neighbours at edit distance one, from a dictionary of trie-node pairs.

The words of all texts are counted; their distinct forms make a dictionary.
Every prefix is a node of the forward trie, every suffix one of the reversed
trie.  A word stands under the pair (node before i, node after i) for every
character i it could lose, and under (node up to i, node from i) for every
place where it could gain one.  Two words that share a pair of the first kind
differ by one replaced character; a pair of the first kind of one word that is
of the second kind for another tells that the other lacks that character.  The
numbers stand for whole prefixes and suffixes, so joined rows are neighbours
and need no check, and under one pair there are at most as many words as there
are letters.

Numbering: the words are range-partitioned and sorted, and a node is known by
its depth and the first word of the partition that has it.  Only the prefixes
common to the words at both sides of a partition boundary occur in two
partitions; they bear the number of the first boundary they span, which the
driver works out from one pair of words a partition.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, staged

MIN_LENGTH = 7  # code points of a word
MIN_COUNT = 2
DELETE_EVERY = 31
FORM_RATIO = 10  # a form occurs at least so many times as often as its variant
HELD_WORDS = 200_000  # distinct words that a task counts before it passes them on

RUN = re.compile(rf"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_PART = 1 << 32  # word numbers: partition times this, plus place in it


def text_words(doc_id: str, text: str, counts: Counter) -> None:
    """Add the words of one text to ``counts``: runs lower-cased (A-Z), some with one code point deleted."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        run = run.lower() if run.isascii() else run.translate(_LOWER)
        h = zlib.crc32(run.encode(), start)
        if h % DELETE_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < MIN_LENGTH:
                continue
        counts[run] += n


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of every word with at least MIN_COUNT (2) occurrences in all texts."""
    slim = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                text_words(doc_id.as_py(), text.as_py() or "", counts)
                if len(counts) > HELD_WORDS:
                    yield flushed()
        yield flushed()

    found = slim.mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


class _Trie:
    """What a partition must know of its neighbours: ``ends[part] = (depths shared, their numbers)`` for both sides."""

    def __init__(self, edges: list[tuple[int, str, str]]):
        """``edges`` holds (partition, first word, last word) of all partitions with words, in order."""
        none: list[int] = []
        self.before: dict[int, list[int]] = {}
        self.after: dict[int, list[int]] = {}
        self.last = {part: last for part, _, last in edges}
        numbers = none
        for k, (part, first, last) in enumerate(edges):
            self.before[part] = numbers
            if k + 1 == len(edges):
                self.after[part] = none
                break
            spanning = min(len(numbers), _shared(first, last) + 1)
            depths = _shared(last, edges[k + 1][1]) + 1  # the root included
            numbers = [numbers[d] if d < spanning else -(k + 1) for d in range(depths)]
            self.after[part] = numbers

    def numbers(self, word: str, part: int, firsts: list[int]) -> list[int]:
        """The node numbers of the word's prefixes by depth; ``firsts`` has the first word of its partition with each."""
        base = part * _PART
        out = [base + i for i in firsts]
        before, after = self.before[part], self.after[part]
        for d, number in enumerate(before):
            if d >= len(firsts) or firsts[d]:
                break
            out[d] = number
        if after:
            depths = min(len(after), _shared(word, self.last[part]) + 1)
            out[:depths] = after[:depths]
        return out


def _first_words(words: Iterator[str], state: list) -> Iterator[list[int]]:
    """For each of the sorted words, by depth, the place of the first word that has its prefix; ``state`` goes on over calls."""
    place, last, firsts = state
    for word in words:
        depths = _shared(last, word) + 1 if place else 0
        firsts = firsts[:depths] + [place] * (len(word) + 1 - depths)
        yield firsts
        place, last = place + 1, word
    state[:] = place, last, firsts


def _edges(table: DataFrame, column: str) -> _Trie:
    """The first and last word of each partition: one row a partition comes to the driver."""
    rows = table.groupBy("part").agg(F.min(column).alias("first"), F.max(column).alias("last")).orderBy("part").collect()
    return _Trie([(r["part"], r["first"], r["last"]) for r in rows])


def _sorted_by(df: DataFrame, column: str) -> DataFrame:
    return df.repartitionByRange(shuffle_partitions(df.sparkSession), column).sortWithinPartitions(column)


def _mapped(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], list]]) -> DataFrame:
    """``df`` through a function of Arrow batches to columns; ``make`` is called once a task."""
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()),
             "array<bigint>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    kinds = [types[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = make()
        for batch in batches:
            out = [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(columns(batch), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return df.mapInArrow(run, schema)


def _numbered(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``dictionary(wid, word, n)`` and ``tries(wid, n, p, s, lead)`` of the words.

    ``wid`` follows the code-point order; ``p[i]`` and ``s[i]`` are the nodes of
    the prefix and the suffix of length i; ``lead[i]`` tells whether character
    i differs from the one before it.
    """

    def forward():
        part, state = TaskContext.get().partitionId(), [0, "", []]

        def columns(batch: pa.RecordBatch) -> list:
            at = state[0]
            firsts = list(_first_words(batch.column("word").to_pylist(), state))
            wid = range(part * _PART + at, part * _PART + state[0])
            return [batch.column("word"), batch.column("n"), [part] * len(firsts), list(wid), firsts]

        return columns

    left = staged(_mapped(_sorted_by(words, "word"), "word string, n bigint, part int, wid bigint, firsts array<int>", forward), "spelling-prefixes")
    heads = _edges(left, "word")

    def backward():
        part, state = TaskContext.get().partitionId(), [0, "", []]

        def columns(batch: pa.RecordBatch) -> list:
            back = batch.column("back").to_pylist()
            rows = zip(back, batch.column("part").to_pylist(), batch.column("firsts").to_pylist(), strict=True)
            nodes = [heads.numbers(word[::-1], at, firsts) for word, at, firsts in rows]
            return [batch.column("back"), batch.column("n"), [part] * len(back), batch.column("wid"), nodes, list(_first_words(back, state))]

        return columns

    right = _sorted_by(left.select(F.reverse("word").alias("back"), "n", "part", "wid", "firsts"), "back")
    right = _mapped(right, "back string, n bigint, part int, wid bigint, p array<bigint>, firsts array<int>", backward)
    right = staged(right, "spelling-suffixes")
    tails = _edges(right, "back")

    def finished():
        def columns(batch: pa.RecordBatch) -> list:
            back = batch.column("back").to_pylist()
            rows = zip(back, batch.column("part").to_pylist(), batch.column("firsts").to_pylist(), strict=True)
            nodes = [tails.numbers(word, at, firsts) for word, at, firsts in rows]
            lead = [[i == 0 or word[-i - 1] != word[-i] for i in range(len(word))] for word in back]
            return [batch.column("wid"), batch.column("n"), batch.column("p"), nodes, lead]

        return columns

    tries = _mapped(right, "wid bigint, n bigint, p array<bigint>, s array<bigint>, lead array<boolean>", finished)
    return left.select("wid", "word", "n"), tries


def near_words(tries: DataFrame) -> DataFrame:
    """``(wid, n, n_near, best_n, best)``: each word that has near words, how many, and the one of largest n (least wid)."""
    length = F.size("lead")

    def entry(prefix: Column, suffix: Column, skip: bool, lead: Column) -> Column:
        return F.struct(
            F.get("p", prefix).alias("p"), prefix.alias("pd"), F.get("s", suffix).alias("s"), suffix.alias("sd"),
            F.lit(skip).alias("skip"), lead.alias("lead"),
        )

    # One of several equal letters in a row stands for all: dropping any gives the same word.
    skips = F.transform(F.sequence(F.lit(0), length - 1), lambda i: entry(i, length - 1 - i, True, F.get("lead", i)))
    splits = F.transform(F.sequence(F.lit(0), length), lambda i: entry(i, length - i, False, F.lit(True)))
    entries = tries.select("wid", "n", F.explode(F.concat(skips, splits)).alias("e"))
    member = F.struct("wid", "n", F.col("e.skip").alias("skip"), F.col("e.lead").alias("lead"))
    # One word at most splits at a pair, and the words that skip there differ in one letter: short lists.
    pairs = entries.groupBy("e.p", "e.pd", "e.s", "e.sd").agg(F.collect_list(member).alias("m")).where(F.size("m") > 1)

    def partners(x: Column) -> Column:
        def near(y: Column) -> Column:
            replaced = x["skip"] & y["skip"] & (x["wid"] != y["wid"])
            dropped = (x["skip"] != y["skip"]) & x["lead"] & y["lead"]
            return replaced | dropped

        return F.transform(F.filter("m", near), lambda y: F.struct((-y["n"]).alias("minus_n"), y["wid"].alias("wid")))

    found = F.transform("m", lambda x: F.struct(x["wid"].alias("wid"), x["n"].alias("n"), partners(x).alias("near")))
    rows = pairs.select(F.explode(found).alias("x")).where(F.size("x.near") > 0)
    rows = rows.select("x.wid", "x.n", F.size("x.near").alias("near"), F.array_min("x.near").alias("best"))
    near = rows.groupBy("wid").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return near.select("wid", "n", "n_near", (-F.col("best.minus_n")).alias("best_n"), F.col("best.wid").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``(wid, root)``: the last word reached over ``forms(wid, form)``, by doubling the steps.

    Counts rise at least FORM_RATIO-fold from step to step, so a chain is at
    most as long as the largest count has digits, and the rounds are few.
    """
    reached = staged(forms.select("wid", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = reached.select(F.col("wid").alias("at"), F.col("root").alias("next"))
        stepped = reached.join(further, F.col("root") == F.col("at"), "left")
        stepped = staged(stepped.select("wid", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        reached = stepped.select("wid", "root")
        if stepped.where("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root (strings), n, n_near, form_n.

    A word's form is its near word (one code point inserted, deleted or
    replaced) of largest n, ties to the smaller in code-point order, if that n
    is at least FORM_RATIO (10) times the word's; its root is where following
    forms ends.  A NULL or empty text has no words, a NULL id reads as an empty
    one, repeated rows count each, other columns are ignored; an empty table
    gives no rows.
    """
    dictionary, tries = _numbered(staged(word_counts(docs, id_col=id_col, text_col=text_col), "spelling-words"))
    near = staged(near_words(tries), "spelling-near")
    forms = near.where(F.col("best_n") >= FORM_RATIO * F.col("n")).select("wid", F.col("best").alias("form"), F.col("best_n").alias("form_n"))
    roots = _roots(forms).select(F.col("wid").alias("rooted"), "root")

    def named(number: str, name: str) -> tuple[DataFrame, Column]:
        words = dictionary.select(F.col("wid").alias(f"{number}_wid"), F.col("word").alias(name))
        return words, F.col(number) == F.col(f"{number}_wid")

    resolved = forms.join(roots, F.col("wid") == F.col("rooted")).select("wid", "form", "form_n", "root")
    for number, name in (("form", "form_word"), ("root", "root_word")):
        resolved = resolved.join(*named(number, name))
    resolved = resolved.select(F.col("wid").alias("formed"), "form_word", "form_n", "root_word")
    counted = near.select(F.col("wid").alias("counted"), "n_near")
    out = dictionary.join(counted, F.col("wid") == F.col("counted"), "left").join(resolved, F.col("wid") == F.col("formed"), "left")
    return out.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("form_n").cast("long").alias("form_n"),
    )
