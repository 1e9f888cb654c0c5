"""The other document operators: brute force, round trips, held-out accuracy, odd rows."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import ORACLE_SF
from tests.oracle_harness import digest, duck
from tripmart.llm import chat, licenses, mixing, packing, pii, quality_rules, queries, syncmers, toxicity
from tripmart.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, "en", "a", 0), (2, "", None, "a", 0), (None, "x y", "en", None, 3), (3, "a b", "en", "b", 3), (3, "a b", "en", "b", 3),
       (4, "word " * 30000, "en", "b", 150000)]


def frame(spark, rows=ODD):
    return spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("h", F.lit(0))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    df = queries.queries()[name](spark, ORACLE_SF)
    found = duck(ORACLE_SF).execute(queries.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, found.fetchall())


OPERATORS = {
    "quality": quality_rules.quality_verdicts,
    "keep": quality_rules.keep_good_documents,
    "licenses": licenses.scan_licenses,
    "syncmers": syncmers.fingerprints,
    "pii": pii.find_personal_data,
    "mix": mixing.mix,
    "mixed": mixing.mixed_documents,
    "pack": packing.pack,
    "toxicity": lambda d: toxicity.score_documents(d, toxicity.fit([])),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, name):
    assert OPERATORS[name](frame(spark).limit(0)).collect() == []
    rows = OPERATORS[name](frame(spark)).collect()
    if name not in ("keep", "mixed", "pack"):
        assert len(rows) == len(ODD)


def test_hosts(spark):
    good, bad = "many good words stand here in a row that is long enough", "few"
    rows = [(i, good, "en", "clean", 1) for i in range(40)] + [(100 + i, bad, "en", "junk", 1) for i in range(40)]
    rows += [(200, good, "en", "junk", 1), (201, good, "en", None, 1)]
    got = {r.doc_id: r for r in quality_rules.quality_verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[0].kept and got[201].kept and got[200].host_rejected and not got[200].kept and got[100].base_failed
    kept = quality_rules.keep_good_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id for r in kept} == {i for i, r in got.items() if r.kept} and kept[0].__fields__ == list(DOCS.split()[::2])


def test_syncmers(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rng.choices(words, k=n)) for n in (0, 3, 8, 9, 10, 40, 41, 300)] + ["É a\nb", ""]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in syncmers.fingerprints(spark.createDataFrame(rows, DOCS)).collect()}
    for i, t in enumerate(texts):
        half = len(t) // 2
        edited = t[: len(t) - half] + texts[i - 1][:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[0].fingerprint == got[9].fingerprint == "" and got[7].near_edited > got[7].near_next == 0
    # A closed syncmer has its least s-mer at an edge, and only such k-mers are chosen.
    word_hash = {r.w: r.h for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    w = texts[7].split()
    pairs = spark.createDataFrame([(i, word_hash[a], word_hash[b]) for i, (a, b) in enumerate(zip(w, w[1:]))], "i int, a long, b long")
    s = [r.s for r in pairs.select("i", F.xxhash64("a", "b").alias("s")).orderBy("i").collect()]
    want = [i for i in range(len(w) - 8) if min(s[i : i + 8]) in (s[i], s[i + 7])]
    assert [int(x.split(":")[1], 16) for x in got[7].fingerprint.split(",")] == want


def test_short_texts_without_syncmers_have_an_anchor(spark):
    texts = [" ".join(f"t{i}w{j}" for j in range(9 + i % 6)) for i in range(60)]  # 9 to 14 words, no word in common
    got = syncmers.fingerprints(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)).collect()
    assert all(r.fingerprint and r.near_next < 1 for r in got) and len({r.fingerprint for r in got}) == len(texts)
    longer = [(2 * i + j, t + " more" * j, "en", "s", 0) for i, t in enumerate(texts) for j in (0, 1)]
    near = {r.doc_id: r.near_next for r in syncmers.fingerprints(spark.createDataFrame(longer, DOCS)).collect()}
    assert sum(near[2 * i + 1] > 0 for i in range(len(texts))) > 40  # a word added at the end moves few anchors


def test_likeness_follows_from_the_fingerprints(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 120))) for _ in range(60)]
    got = syncmers.fingerprints(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)).collect()
    by_id = {r.doc_id: r for r in got}

    def found(fingerprint):
        anchors = [(h, int(p, 16)) for h, p in (x.split(":") for x in fingerprint.split(",") if x)]
        return {(a, b, p - q) for (a, q), (b, p) in zip([("", 0), *anchors], anchors)}

    def alike(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, r in by_id.items():
        assert r.near_edited == alike(found(r.fingerprint), found(r.edited_fingerprint))
        assert r.near_next == alike(found(r.fingerprint), found(by_id[(i - 1) % len(texts)].fingerprint))


def test_fingerprints_do_not_depend_on_case(spark):
    texts = ["Öl und Äther: " + "Größe ΑΒΓ word " * 9, "öl UND äther: " + "größe αβγ WORD " * 9]
    got = syncmers.fingerprints(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)).collect()
    assert got[0].fingerprint == got[1].fingerprint != "" and got[0].near_next == got[1].near_next == 1


def test_next_documents_of_hot_and_missing_ids(spark):
    rng = random.Random(5)
    ids = [None] * 300 + [7] * 300 + [-3, 0, 6, 8, 9] + rng.sample(range(100, 10**6), 200)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 20))) + f" {n}", "en", "s", 0) for n, i in enumerate(ids)]
    rows += [(7, "the same text", "en", "s", 0)] * 200
    df = spark.createDataFrame(rows, DOCS)
    order = [(r.doc_id, r.text) for r in df.orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text").desc()).collect()]
    want = sorted((str(i), t, order[(n + 1) % len(order)][1]) for n, (i, t) in enumerate(order))
    got = syncmers.with_next(df.select("doc_id", "text"), ["text"]).collect()
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in got) == want
    bounds, hot = syncmers._ranges(df, 16)
    assert hot == [7]
    spread = df.groupBy(syncmers._bucket(F.col("doc_id"), F.xxhash64("text"), bounds, hot).alias("b"), "doc_id").count()
    assert spread.where("doc_id IS NULL").count() > 250 and spread.where("doc_id = 7").count() > 250


REGEX = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_pii(text):
    found = []
    for kind, pattern in REGEX.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                ds = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
                if not 13 <= len(digits) <= 19 or sum(d - 9 * (d > 9) for d in ds) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def test_base_spans():
    rng = random.Random(4)
    bits = ["a", "b.c", "@", ".", "-", "+1", "42", "255", "256", " ", "4111111111111111", "x_y", "1.2.3.4", "(", ")", "é"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 14)))
        assert pii.detect(text) == slow_pii(text), text
    assert pii.detect("a" * 200_000 + "1" * 200_000) == []
    zeros = "0" * 5000 + "1.2.3.4"  # more digits than int() reads
    assert pii.detect(zeros) == [("ip", 0, len(zeros))]


def test_added_spans_hold_base_ones_whole_or_not_at_all():
    rng = random.Random(8)
    bits = ["bob@ex.org", "ann [at] ex [dot] org", " at ", " dot ", "1.2.3.4", " ", "，", "x", "１.2.3.4", "(at)", "q@w.e [dot] r"]
    for _ in range(2000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 12)))
        base, spans = pii.find(text)
        tape = pii.deobfuscate(text)
        moved = [(k, *tape.source(s, e)) for k, s, e in pii.detect(tape.text)] if tape else []
        cuts = lambda x, y: x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and not (x[1] <= y[1] and y[2] <= x[2])
        new = [x for x in moved if x not in base and not any(cuts(x, y) for y in base)]
        assert sorted(spans) == sorted(base + new), text


@pytest.mark.parametrize(
    ("text", "kind", "shown"),
    [
        ("mail bob [at] example [dot] com now", "email", "bob [at] example [dot] com"),
        ("mail bob at example dot co dot uk now", "email", "bob at example dot co dot uk"),
        ("ｂob＠example．com", "email", "ｂob＠example．com"),
        ("is bоb@exаmple.com yours", "email", "bоb@exаmple.com"),
        ("call plus four four two oh seven nine four six oh nine five eight", "phone", "plus four four two oh seven nine four six oh nine five eight"),
        ("host １０.0.0.１ up", "ip", "１０.0.0.１"),
    ],
)
def test_disguises(text, kind, shown):
    base, spans = pii.find(text)
    assert [k for k, s, e in spans if text[s:e] == shown] == [kind] and set(base) <= set(spans)


@pytest.mark.parametrize(
    ("text", "kind", "shown"),
    [
        ("call +1 five five five 123 4567 now", "phone", "+1 five five five 123 4567"),
        ("call +1 (five five five) 123-4567", "phone", "+1 (five five five) 123-4567"),
        ("call plus one 706 five five five 0199", "phone", "plus one 706 five five five 0199"),
        ("call plus four, four, two, oh, seven, nine, four, six, oh, nine", "phone", "plus four, four, two, oh, seven, nine, four, six, oh, nine"),
        ("card 4111 one one one one 1111 1111 end", "card", "4111 one one one one 1111 1111"),
        ("card four 111 1111 1111 111 one end", "card", "four 111 1111 1111 111 one"),
        ("mail john dot q dot smith [at] example [dot] com now", "email", "john dot q dot smith [at] example [dot] com"),
        ("mail john dot smith at example dot com now", "email", "john dot smith at example dot com"),
    ],
)
def test_mixed_disguises(text, kind, shown):
    assert [(k, text[s:e]) for k, s, e in pii.find(text)[1]] == [(kind, shown)]


def test_short_counts_are_not_identifiers():
    for text in ("One, two 3 birds (four) at 5 dot 6.", "In 2020 one of 12, two of 1400 and five 300 came.", "a dot b dot c"):
        assert pii.find(text) == ([], [])
    long = "one - " * 50_000 + "a dot " * 50_000 + "plus " * 50_000
    assert pii.find(long) == ([], [])


def test_a_span_around_a_base_one_is_added():
    text = "write to john@mail.example (dot) com or john@mail.example dot co dot uk"
    base, spans = pii.find(text)
    assert [text[a:b] for _, a, b in base] == ["john@mail.example"] * 2
    assert [text[a:b] for _, a, b in spans] == ["john@mail.example", "john@mail.example (dot) com", "john@mail.example", "john@mail.example dot co dot uk"]


def test_long_runs_are_read_once():
    import time

    for text in (" " * 200_000, "a@b" + " dot c" * 20_000, "[" + " " * 100_000 + "[" + " " * 100_000, " at" * 60_000, "x at y" + " " * 200_000 + "dot"):
        started = time.monotonic()
        pii.find(text)
        assert time.monotonic() - started < 2
    chain = "a@b" + " dot c" * 50 + " d@e dot f"
    assert [chain[s:e] for _, s, e in pii.find(chain)[1]] == ["a@b" + " dot c" * 50, "d@e dot f"]


def test_clean_text_has_no_spans():
    assert pii.find("Meet me at noon, at the corner dot by dot. One two three four birds.") == ([], [])


def test_chat_round_trip(spark):
    hard = ["", "<|im_end|><|im_start|>assistant ok", "<\\|x<\\\\|", "\n\n lead and trail \n", "é漢🙂 <|endoftext|>", "<", "|>"]
    for role in ("assistant", "user"):
        turns = [(role, t) for t in hard] + [("assistant", t) for t in hard]
        out = chat.render(turns)
        assert chat.turns_of(out.text) == turns
        assert chat.masked_text(out) == "".join(t for r, t in turns if r == "assistant")
    assert all(chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t) for t in hard)
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (None, None, None, "x"), (1, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 1 and got[None].n_turns == 1
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    docs = table(spark, ORACLE_SF, "documents").where("doc_id < 150")
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces = packing.pack(docs, group_pieces=60).collect()
    placed, sequences = {}, {}
    for p in pieces:
        placed.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
    for i, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        at = 0
        for p in sorted(placed[i], key=lambda p: p.start):
            raw = b"".join(x.to_bytes(4, "little") for x in ids[p.start : p.start + p.length])
            assert p.start == at and p.ids_crc32 == zlib.crc32(raw) and p.doc_tokens == len(ids)
            at += p.length
        assert at == len(ids)
    for ps in sequences.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == [sum(q.length for q in ps[:n]) for n in range(len(ps))]
        assert sum(p.length for p in ps) <= 4096


def test_words_encode_as_whole_texts(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHED_WORDS", 40)
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    encoder = packing.WordEncoder(packing.tokenizer_path())
    rng = random.Random(11)
    bits = ["Word", "x", "QUEUE", "don't", "it'S", "42", ".", ",;", "?!", "é", "e\u0301", "h\u0331", "H\u0331", "İ", "ΣΑΣ", "ß", "你好", "😀", "\u200b",
            "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>.", "\u00a0", "\u2003", "\x1c", "\x85", "\u0301", "\x00", "K", "_", "<", "Ñandú", "µª", "ŉ", "Ǆ", "ɏ"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) + rng.choice(["", "", " ", "\n", "\t ", "\r\x0b\x0c"]) for _ in range(rng.randint(0, 12)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        got = encoder.encode(text.encode())
        assert got == b"".join(x.to_bytes(4, "little") for x in ids), text.encode("unicode_escape")


def test_first_fit_decreasing():
    import numpy as np

    rng = random.Random(9)
    for _ in range(50):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(1, 40))]
        rooms, want = [], {}
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            b = next((b for b, r in enumerate(rooms) if r >= sizes[i]), len(rooms))
            if b == len(rooms):
                rooms.append(20)
            want[i] = (b, 20 - rooms[b])
            rooms[b] -= sizes[i]
        bins, offsets = packing.first_fit_decreasing(np.array(sizes), 20)
        assert [want[i] for i in range(len(sizes))] == list(zip(bins.tolist(), offsets.tolist()))


def test_mixing(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 60), "en", rng.choice(["a", "b", "b", "b", "c", None]), 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()))
    totals = {s: sum(len(t.split()) for _, t, _, x, _ in rows if x == s) for s in ("a", "b", "c", None)}
    weights, level, capped = dict(zip(("a", "b", "c", None), (1, 2, 3, 1))), 0.0, set()
    while True:
        free = [s for s in totals if s not in capped]
        level = (sum(totals.values()) - sum(3 * totals[s] for s in capped)) / sum(weights[s] for s in free)
        more = {s for s in free if weights[s] * level > 3 * totals[s]}
        if not more:
            break
        capped |= more
    source = {i: s for i, _, _, s, _ in rows}
    for s in totals:
        own = [r for r in got if source[r.doc_id] == s]
        target = min(weights[s] * level, 3 * totals[s])
        assert own[0].target == pytest.approx(target) and own[0].source_size == totals[s]
        assert abs(sum(r.copies * r.size for r in own) - target) <= 60 and max(r.copies for r in own) <= 3


def test_mixing_refines_large_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SORT_ROWS", 5)
    docs = table(spark, ORACLE_SF, "documents")
    got = mixing.mix(docs, carry=["doc_id", "source"]).groupBy("source").agg(
        F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("n"), F.max("size").alias("m"))
    assert all(abs(r.n - r.t) <= r.m for r in got.collect())


def test_longer_documents_are_drawn_more_often(spark, monkeypatch):
    rows = [(i, "w " * (8 if i % 2 else 128), "en", "ab"[i % 40 == 0], 0) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    drawn = {8: 0, 128: 0}
    for seed in range(12):
        monkeypatch.setattr(mixing, "SEED", seed)
        got = mixing.mix(docs, carry=["doc_id", "source"]).where("source = 'a'").collect()
        assert abs(sum(r.copies * r.size for r in got) - got[0].target) <= 128
        for r in got:
            drawn[r.size] += r.copies
    want = {r["cls"]: r["whole"] + r["p"] for r in mixing._wanted(
        docs.select(F.struct("source").alias("sk"), mixing.n_words(F.col("text")).alias("size")).withColumn("cls", mixing.size_class(F.col("size"))),
        mixing.source_targets(docs.select(F.struct("source").alias("sk"), mixing.n_words(F.col("text")).alias("size"))), 3).collect() if r.sk.source == "a"}
    assert want[7] == pytest.approx(2 * want[3]) and 0 < want[7] < 1  # 2^(4/4) times as often
    for size, cls in ((8, 3), (128, 7)):
        n = sum(1 for _, t, _, s, _ in rows if s == "a" and len(t.split()) == size)
        assert drawn[size] / (12 * n) == pytest.approx(want[cls], rel=0.1)


def test_license_forms(spark):
    mit = "Copyright (c) 2020 A. Person\n\n" + licenses.MIT_TEXT.replace("sublicense", "sub-licence").upper()
    rows = [(1, mit, "en", "s", 0), (2, "x\nReleased  under the MIT Licence!\ny", "en", "s", 0), (3, "MIT", "en", "s", 0)]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1].whole_license == "MIT" and got[2].whole_license is None and got[2].licenses == "MIT"
    assert got[2].n_license_lines == 1 and got[3].licenses == ""


def test_license_sql_knows_all_texts(spark, tmp_path):
    heads = ["", "Copyright (c) 2020 A. Person\n\n", "(c) The Authors\n", "\u00a9 The Authors\n"]
    texts = [h + t + "\n" for i, (_, t) in enumerate(licenses.ALL_KNOWN) for h in (heads if i % 7 == 0 else heads[i % 4 : i % 4 + 1])]
    texts += [t.replace("license", "licence").upper() for t in texts[:40]] + ["a) one\n(b) two\n(c) three", "(c) three", None, ""]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = licenses.scan_licenses(spark.read.parquet(str(tmp_path / "documents.parquet")))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = con.execute(licenses.ORACLE)
    columns = [d[0] for d in found.description]
    want = found.fetchall()
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest(columns, want)
    assert sum(r[columns.index("whole_license")] is not None for r in want) > 400


def test_whole_licenses(spark):
    from pathlib import Path

    folder = Path(licenses.__file__).parent / "license_texts"
    apache = (folder / "Apache-2.0.txt").read_text()
    bsd = """Copyright 2019 The Authors. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:

   * Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
   * Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the
distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR
A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
OWNER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
    names = """   * Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""
    mit0 = licenses.MIT_TEXT.replace(", subject to the following conditions:", ".").split("\n")
    cases = [
        ("MIT", "The MIT License (MIT)\n\nCopyright (c) Microsoft Corporation.\n\n" + licenses.MIT_TEXT),
        ("MIT", "MIT License\n(c) Facebook, Inc. and its affiliates.\n" + licenses.MIT_TEXT),
        ("MIT", "© The Authors\n" + licenses.MIT_TEXT),
        ("MIT-0", "\n".join([mit0[0], mit0[2]])),
        ("BSD-2-Clause", "BSD 2-Clause License\n" + bsd % ""),
        ("BSD-3-Clause", bsd % names),
        ("BSD-3-Clause", (bsd % names).replace("reserved.\n", "reserved.\nAll rights reserved.\n", 1).replace("OWNER", "HOLDER")),
        ("0BSD", licenses.ISC_TEXT.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")),
        ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2020 A. Person")),
        ("Apache-2.0", " ".join(apache[: apache.index("END OF TERMS")].split())),
        (None, apache.replace("(c) You must retain", "(c) You may drop")),
        (None, licenses.MIT_TEXT.replace("without restriction", "with restriction")),
    ]
    files = sorted(folder.glob("*.txt"))
    assert len(files) == 12
    cases += [(f.stem, f.read_text()) for f in files]
    rows = [(i, t, "en", "s", 0) for i, (_, t) in enumerate(cases)]
    got = {r.doc_id: r.whole_license for r in licenses.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[i] for i in range(len(cases))] == [n for n, _ in cases]


def test_toxicity_learns_sentences():
    rng = random.Random(8)
    calm, rude = [f"word{chr(97 + i)}" for i in range(26)], ["idiot", "scumbag"]

    def text(toxic):
        parts = [" ".join(rng.choices(calm, k=8)) for _ in range(rng.randint(3, 12))]
        if toxic:
            parts[rng.randrange(len(parts))] += " " + rng.choice(rude)
        return ". ".join(parts)

    def bags(n):
        made = [(i % 4 == 0, text(i % 4 == 0)) for i in range(n)]
        return [(int(y), [sorted({f for w in ws for f in toxicity.features(w)}) for *_, ws in toxicity.sentences(t)]) for y, t in made]

    weights, bias = toxicity.fit(bags(400))
    right = 0
    for y, bag in bags(200):
        z = [bias + sum(weights[f] for f in s) for s in bag]
        right += (max(z) >= 0) == bool(y)
    assert right >= 195


def test_toxicity_scores_match_a_slow_version(spark):
    rng = random.Random(9)
    words = ["rude", "awful", "plain", "nice", "word", "é"]
    weights, bias = toxicity.fit([])[0], -5.0
    for w in words[:4]:
        for f in toxicity.features(w):
            weights[f] = rng.choice([2.5, 1.0, -1.0, 0.01])
    texts = [" ".join(rng.choices([*words, ".", "!", "\n"], k=rng.randint(0, 60))) for _ in range(40)] + ["", None, "...", "rude"]
    got = toxicity.score_documents(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS), (weights, bias))
    got = {r.doc_id: r for r in got.collect()}
    for i, t in enumerate(texts):
        parts = [m for m in re.finditer(r"[^.!?\n]+", t or "") if re.search(r"[^\W\d_]", m[0])]
        z = [bias + sum(weights[f] for f in sorted({f for w in re.findall(r"[^\W\d_]+", m[0].lower()) for f in toxicity.features(w)})) for m in parts]
        sure = [1 / (1 + np.exp(-x)) for x in z]
        left = 1 - 1 / (1 + np.exp(-bias))
        want = 1 - left * np.prod([(1 - p) / left for p in sure if p > 1 - left])
        assert got[i].score == pytest.approx(want, abs=1e-9) and got[i].predicted == int(want >= 0.7)
        assert got[i].n_offending == sum(p >= 0.5 for p in sure)
        worst = parts[z.index(max(z))].span() if parts else (0, 0)
        assert (got[i].worst_start, got[i].worst_end) == worst


def test_toxicity_does_not_rise_with_length(spark):
    def bag(text):
        return [sorted({f for w in ws for f in toxicity.features(w)}) for *_, ws in toxicity.sentences(text)]

    rng = random.Random(10)
    calm = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(300)]
    clean = [". ".join(" ".join(rng.choices(calm, k=8)) for _ in range(rng.randint(2, 30))) for _ in range(400)]
    toxic = [t + ". you idiot" for t in clean[:100]]
    model = toxicity.fit([(0, bag(t)) for t in clean[100:]] + [(1, bag(t)) for t in toxic])
    long = ". ".join(" ".join(rng.choices(calm, k=8)) for _ in range(10000))
    rows = [(1, long, "en", "s", 0), (2, long + ". you idiot", "en", "s", 0), (3, "you idiot", "en", "s", 0)]
    score = {r.doc_id: r.score for r in toxicity.score_documents(spark.createDataFrame(rows, DOCS), model).collect()}
    assert score[1] < 0.1 and score[2] >= 0.7 and score[3] >= 0.7


def test_toxicity_ignores_held_out_labels(spark):
    docs, labels = table(spark, ORACLE_SF, "documents"), table(spark, ORACLE_SF, "labels")
    sample = toxicity.training_sample(docs, labels)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.training_sample(docs, flipped)
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, again.collect()))
    held = {r.doc_id for r in docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("x")).where("x").collect()}
    assert held == {i for (i,) in duckdb.sql(f"SELECT doc_id FROM '{ORACLE_SF}/documents.parquet'").fetchall() if zlib.crc32(str(i).encode()) % 3 == 1}
