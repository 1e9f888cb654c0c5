"""The filter audit against its SQL (test_documents) and, for odd rows, a slow version over documents."""

from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from tripmart.llm import filter_audit

GOOD = " ".join(f"w{i}" for i in range(60))


def slow_audit(docs, labels):
    masks = []
    for doc_id, text, source in docs:
        t = text or ""
        w = [x for x in t.replace("\t", " ").replace("\n", " ").split(" ") if x]
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                 "D": any(c in "#$%&*|" for c in t),
                 "E": any((o or "") == t and i is not None and (doc_id is None or i < doc_id) for i, o, _ in docs)}
        good = any(i == doc_id and q == 1 for i, q, _ in labels if i is not None)
        toxic = any(i == doc_id and x == 1 for i, _, x in labels if i is not None)
        masks.append((source or "", {f for f in "ABCDE" if fails[f]}, good, toxic))
    out, removed_by = {}, Counter()
    for part in {m[0] for m in masks}:
        for order in permutations("ABCDE"):
            left = [m for m in masks if m[0] == part]
            everything = left
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                row = (len(left) - len(gone), len(gone), sum(f in m[1] for m in everything) - len(gone),
                       sum(m[1] == {f} for m in everything), sum(m[2] for m in gone), sum(m[3] for m in gone))
                left = [m for m in left if f not in m[1]]
                out[part, "".join(order), step] = row
                removed_by[part, f] += len(gone)
    return {(p, o, s): (*row, removed_by[p, o[s - 1]]) for (p, o, s), row in out.items()}


def test_odd_rows(spark):
    docs = [(1, None, "a"), (2, "", None), (None, "", "a"), (3, GOOD, "a"), (3, GOOD, "a"), (4, GOOD, ""), (None, GOOD, "b"),
            (5, GOOD + " # X", "b"), (6, "word " * 20_000, "b"), (7, "A" * 60, "b"), (8, GOOD.upper(), "a"), (None, "only here", "b"),
            (None, "only here", "b"), (-1, "word " * 20_000, "b")]
    labels = [(1, 1, 1), (3, 0, None), (3, 1, 0), (5, None, 1), (None, 1, 1), (8, 1, 0), (99, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    d = d.withColumns({"mask": F.lit("clash"), "part": F.lit(1), "digest": F.lit(0), "quality": F.lit(1)})
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(True))
    df = filter_audit.audit(d, lab)
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}
    assert got == slow_audit(docs, labels) and len(got) == 3 * 600
    assert dict(df.dtypes) == {"part": "string", "filter_order": "string", "step": "int",
                               **{c: "bigint" for c in (*filter_audit.COUNTS, "shapley")}}
    assert filter_audit.audit(d.limit(0), lab).collect() == []
    unlabelled = filter_audit.audit(d, lab.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(unlabelled) == (0, 0)
