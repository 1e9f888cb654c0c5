"""SimHash classes and line dedup against brute force."""

import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tripmart.llm import line_dedup, simhash
from tripmart.llm.common import staged

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, None) for i, t in texts], DOCS)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def classes(nodes, linked):
    """Least node of each connected set."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate(
        {i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b", "a b c", "É é a\vb  C d e f", "x y z " * 9000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_links_match_all_pairs(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for fp in list(fps):
        for bits in (1, 2, 3, 4, 5):
            for b in rng.sample(range(64), bits):
                fp ^= 1 << b
            fps.append(fp)
    signed = [f - (1 << 64) if f >> 63 else f for f in set(fps) | {0, 1 << 63}]
    got = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    want = {(max(p), min(p)) for p in itertools.combinations(signed, 2) if ((p[0] ^ p[1]) & (2**64 - 1)).bit_count() <= 3}
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)


def test_classes(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=150)) for _ in range(8)]
    texts = base + [t + " tail" for t in base] + base[:3] + ["", None, "  "]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, texts[0]), (None, "lonely words stand here")]
    got = simhash.near_duplicate_classes(docs(spark, rows)).collect()
    fps = {i: slow_fingerprint(t) for i, t in enumerate(texts)}
    linked = [p for p in itertools.combinations(fps, 2) if (fps[p[0]] ^ fps[p[1]]).bit_count() <= 3]
    want = classes(fps, linked)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.fingerprint == f"{fps[r.doc_id]:016x}" and r.component_id == want[r.doc_id]
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["0", "None"]
    kept = simhash.keep_one_per_class(docs(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted([*map(str, set(want.values())), "None"])


def test_empty_and_extra_columns(spark):
    none = docs(spark, []).withColumn("fp", F.lit(1)).withColumn("root", F.lit("x"))
    assert simhash.near_duplicate_classes(none).collect() == []
    assert simhash.keep_one_per_class(none).collect() == []
    assert line_dedup.dedup_lines(none).collect() == []
    some = docs(spark, [(1, "a"), (1, "a")]).withColumn("fp", F.lit(1)).withColumn("h", F.lit(2))
    assert simhash.keep_one_per_class(some).count() == 1
    assert line_dedup.dedup_lines(some).columns[:7] == ["doc_id", "lang", "source", "n_chars", "fp", "h", "text"]


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_banded_distance(spark, tau):
    rng = random.Random(tau)
    pairs = []
    for _ in range(250):
        a = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, tau + 1)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "é"])
        if abs(len(a) - len(b)) <= tau:
            pairs.append((a, "".join(b)))
    df = staged(line_dedup.trimmed(spark.createDataFrame(pairs, "a string, b string"), "a", "b"), "trimmed")
    df = df.withColumn("may", line_dedup.may_be_within(F.col("__a"), F.col("__b"), tau))
    for r in line_dedup.banded_distance(df, tau).collect():
        true = levenshtein(r.a, r.b)
        assert (r.distance == true) if true <= tau else (r.distance > tau), (r.a, r.b)
        assert r.may or true > tau


def brute_lines(rows, tau, min_chars):
    places = [(i, n, x) for i, t in rows for n, x in enumerate((t or "").split("\n")) if len(x) >= min_chars]
    lines = sorted({x for *_, x in places})
    linked = [p for p in itertools.combinations(lines, 2) if abs(len(p[0]) - len(p[1])) <= tau and levenshtein(*p) <= tau]
    of = classes(lines, linked)
    first = {}
    for i, n, x in sorted(places):
        first.setdefault(of[x], (i, n))
    lost = {(i, n) for i, n, x in places if first[of[x]] != (i, n)}
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in lost) for i, t in rows if t is not None}


def test_line_dedup(spark):
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "é", "straße"]
    base = [" ".join(rng.choices(words, k=rng.randint(9, 14))) for _ in range(12)]

    def noisy(x):
        x = list(x)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(x))
            x[at : at + rng.randint(0, 1)] = rng.choice(["", "z", "Q"])
        return "".join(x)

    rows = [(i, "\n".join([noisy(rng.choice(base)) for _ in range(6)] + ["short", "short", ""])) for i in range(25)]
    rows += [(90, ""), (91, None), (92, base[0] + "\n" + base[0])]
    got = line_dedup.dedup_lines(docs(spark, rows)).collect()
    want = brute_lines(rows, line_dedup.TAU, line_dedup.MIN_CHARS)
    assert {r.doc_id: r.text for r in got if r.text is not None} == want
    assert [r.doc_id for r in got if r.text is None] == [91] and len(got) == len(rows)


def test_repeated_rows_and_null_ids(spark):
    long = "this line is long enough to be compared with others"
    got = line_dedup.dedup_lines(docs(spark, [(1, long), (1, long), (None, long), (2, long + "!")])).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("1", ""), ("1", ""), ("2", ""), ("None", long)]


def test_exact_repeats_of_shorter_lines(spark):
    notice = "Released under the MIT License."
    rows = [(1, f"{notice}\nhead\n{notice}\n--------"), (2, f"own line\n{notice}\n--------\nhead"), (3, f"{notice}!\nown line\nOwn line")]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    assert got[1].text == f"{notice}\nhead\n--------" and got[1].dropped == [2]
    assert got[2].text == "own line\n--------\nhead" and got[2].dropped == [1]
    assert got[3].text == f"{notice}!\nOwn line" and got[3].dropped == [1]
