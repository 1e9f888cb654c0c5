"""The corpus pipeline: each stage on odd rows, and the whole chain against what its stages must keep."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tripmart.llm import line_dedup, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
GOOD = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


def prose(i):
    return " ".join(f"{w}{i}{j}" for j, w in enumerate(GOOD.split() * 3))


ODD = [(1, None, "en", "a", 0), (2, "", None, "a", 0), (None, prose(1), "en", None, 3), (3, prose(2), "en", "b", 3), (3, prose(2), "en", "b", 3),
       (4, prose(3) + "\n" + "very long " * 20_000, "en", "b", 1), (5, prose(4), "en", "a", 0), (6, prose(4), "en", "a", 0)]


def frame(spark, rows=ODD):
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({"dropped": F.lit("own"), "n_lines": F.lit(-1), "n_dropped": F.lit(-2), "h": F.lit(0), "component_id": F.lit(9)})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_odd_rows(spark, name, stage):
    docs = frame(spark)
    assert stage(spark, docs.limit(0), "").collect() == []
    out = stage(spark, docs, "")
    rows = out.collect()
    assert rows
    if name != "packing":
        assert out.columns == docs.columns
        assert {(r.dropped, r.n_lines, r.n_dropped) for r in rows} == {("own", -1, -2)}


def test_chain_by_hand(spark, tmp_path):
    """Five clean texts in many forms: what each stage must drop is known beforehand."""
    shared = "this very line stands in several of the documents, word for word, and only the first may keep it"
    rows = [(i, f"{prose(10 + i)}\n{shared}\n{prose(30 + i)}", "en", "abc"[i % 3], 0) for i in range(12)]
    rows += [(100 + i, f"{prose(10 + i)}\n{shared}\n{prose(30 + i)}", "en", "abc"[i % 3], 0) for i in range(3)]  # copies
    rows += [(200, "few words only", "en", "a", 0), (201, None, "en", "b", 0), (202, "word " * 400, "en", "c", 0)]  # junk
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, "")
    assert sorted(r.doc_id for r in good.collect()) == [*range(12), 100, 101, 102]
    lines = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, good, "").collect()}
    assert lines[0] == rows[0][1] and all(lines[i] == f"{prose(10 + i)}\n{prose(30 + i)}" for i in range(1, 12))
    assert all(lines[100 + i] == "" for i in range(3))
    kept = simhash.keep_one_per_class(corpus_pipeline.lines(spark, good, ""))
    assert sorted(r.doc_id for r in kept.collect()) == [*range(12), 100]  # the emptied copies are one class
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    whole = {}
    for p in pieces:
        whole.setdefault(p.doc_id, []).append((p.start, p.length, p.doc_tokens))
    assert set(whole) <= {*range(12), 100} and len(whole) >= 8
    for parts in whole.values():
        copies = sum(length for _, length, _ in parts) / parts[0][2]
        assert copies in (1, 2, 3)
    rooms = {}
    for p in pieces:
        rooms.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for room in rooms.values():
        assert sum(n for _, n in room) <= 4096 and all(b[0] == a[0] + a[1] for a, b in zip(sorted(room), sorted(room)[1:]))


def test_clashing_columns_are_replaced_in_the_report(spark):
    out = line_dedup.dedup_lines(frame(spark))
    assert len(out.columns) == len(set(out.columns))
    assert {r.doc_id: r.n_dropped for r in out.collect() if r.doc_id in (5, 6)} == {5: 0, 6: 1}
