"""Spelling variants against a brute-force dictionary, and the numbering of trie nodes."""

import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.conftest import ORACLE_SF
from tripmart.llm import spelling
from tripmart.llm.common import table

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def slow_variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    near, masks = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masks[w[:i], w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in masks.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v for w, v in best.items() if words[v] >= 10 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_given_table(spark):
    docs = table(spark, ORACLE_SF, "documents")
    want = slow_variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert len(want) > 1000 and any(x[1] for x in want)
    assert found(spelling.spelling_variants(docs)) == want


def test_odd_rows(spark):
    rng = random.Random(3)
    base = ["aaaaaaa", "aaaaaaaa", "aaaabaaa", "straßen", "straßenn", "Straxen", "ÀÉÎÕÜøÿ", "ÀÉÎÕÜøÿÿ", "×÷×÷×÷×"]
    words = base + ["".join(rng.choices("ab", k=rng.randint(7, 9))) for _ in range(200)]
    rows = [(i, " ".join(rng.choices(words, k=80))) for i in range(60)]
    rows += [(7, "lettern " * 40), (7, "lettern " * 40), (8, "letterns letterns lettern1lettern"), (9, None), (10, ""), (None, "lettern lettern")]
    rows += [(20, "q" * 50_000 + " " + "q" * 50_001), (21, "q" * 50_000 + "-" + "q" * 50_001), (22, ("chaina " * 4) + ("chained " * 2))]
    rows += [(30 + i, "chained " * 30 + "chainedd " * 400) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    odd = docs.withColumns({"word": F.lit("clash"), "n": F.lit(1), "wid": F.lit(2), "part": F.lit(3)})
    want = slow_variants(rows)
    assert any(x[1] and x[2] != x[1] for x in want) or any(x[1] for x in want)
    assert found(spelling.spelling_variants(odd)) == want
    assert spelling.spelling_variants(odd.limit(0)).collect() == []


def test_numbers_name_prefixes_whatever_the_partitions():
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(1, 6))) for _ in range(60)})
    for _ in range(40):
        cuts = sorted(rng.sample(range(1, len(words)), rng.randint(0, 9)))
        parts = [words[a:b] for a, b in zip([0, *cuts], [*cuts, len(words)], strict=True)]
        trie = spelling._Trie([(3 * k, p[0], p[-1]) for k, p in enumerate(parts)])
        by_node = defaultdict(set)
        for k, part in enumerate(parts):
            for word, firsts in zip(part, spelling._first_words(iter(part), [0, "", []]), strict=True):
                for depth, number in enumerate(trie.numbers(word, 3 * k, firsts)):
                    by_node[number, depth].add(word[:depth])
        assert all(len(prefixes) == 1 for prefixes in by_node.values())
        assert len(by_node) == len({w[:d] for w in words for d in range(len(w) + 1)})
