"""Toxicity by multiple-instance learning.

Labels mark documents, not sentences.  A document is a bag of sentences; sentence
s is toxic with probability p_s = sigmoid(b + sum of its features' weights), and
the document's score is the noisy-or 1 - (1 - p_0) prod((1 - p_s) / (1 - p_0)).
p_0 = sigmoid(b) is the probability without evidence: it counts once a document,
and the product is over the sentences with p_s > p_0, so harmless sentences add
nothing however many there are.  The weights are fitted to document labels by
gradient steps on the same likelihood with an L1 shrinkage, so that most features
weigh nothing.  The sentences with a high p_s are the offending ones.

Fitted on a bounded sample of labelled documents (``TRAIN_TOXIC`` and
``TRAIN_CLEAN`` documents of up to ``TRAIN_WORDS`` words, lowest hash first);
every document is scored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_TOXIC, TRAIN_CLEAN = 1500, 3000
TRAIN_WORDS = 1500
BITS = 18
STEPS = 150
TOXIC_WEIGHT = 0.5  # of a toxic document in the likelihood, a clean one weighs 1; chosen on a fold of the training rows
THRESHOLD = 0.7

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
CACHED_WORDS = 500_000


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word: itself and its first four and five letters."""
    mask = (1 << BITS) - 1
    own = [word] if len(word) <= 4 else [word, f"{word[:4]}~", f"{word[:5]}~"]
    return [zlib.crc32(x.encode()) & mask for x in own]


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, lower-case words) of each sentence that has words; an empty bag has one empty sentence."""
    found = [(m.start(), m.end(), _WORD.findall(m[0].lower())) for m in _SENTENCE.finditer(text)]
    return [x for x in found if x[2]] or [(0, 0, [])]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(toxic, text)`` of the bounded sample: never held-out rows, NULL labels or NULL ids."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.where(F.size(F.split("text", " ")) <= TRAIN_WORDS).select("doc_id", "text")
    # Twice the wanted number of ids, as some have long texts; then the bound itself.
    order = F.xxhash64("doc_id")
    ids = usable.where("toxic = 1").orderBy(order).limit(2 * TRAIN_TOXIC)
    ids = ids.union(usable.where("toxic = 0").orderBy(order).limit(2 * TRAIN_CLEAN))
    rows = short.join(F.broadcast(ids), "doc_id")  # at most 2 (TRAIN_TOXIC + TRAIN_CLEAN) ids
    toxic = rows.where("toxic = 1").orderBy(order, "text").limit(TRAIN_TOXIC)
    clean = rows.where("toxic = 0").orderBy(order, "text").limit(TRAIN_CLEAN)
    return toxic.union(clean).select("toxic", "text")


def fit(bags: list[tuple[int, list[list[int]]]], steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias from (label, feature ids of each sentence) bags; no bags give a model that scores low."""
    size, bias = 1 << BITS, -6.0
    weights = np.zeros(size)
    y = np.array([b[0] for b in bags], float)
    if not len(y) or y.min() == y.max():
        return weights, bias
    bag_of = np.repeat(np.arange(len(bags)), [len(b[1]) for b in bags])
    flat = [s for _, ss in bags for s in ss]
    sent_of = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
    feats = np.fromiter((f for s in flat for f in s), np.int64, len(sent_of))
    # Features of one or two bags say nothing about others.
    seen = np.unique(bag_of[sent_of] * size + feats)
    common = np.bincount(seen % size, minlength=size) >= 3
    keep = common[feats]
    sent_of, feats = sent_of[keep], feats[keep]
    used, feats = np.unique(feats, return_inverse=True)
    w, m, v = np.zeros(len(used)), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    each = np.where(y == 1, TOXIC_WEIGHT, 1.0) / len(bags)
    for step in range(1, steps + 1):
        z = np.clip(bias + np.bincount(sent_of, w[feats], len(flat)), -30, 30)
        quiet, base = np.logaddexp(0, bias), 1 / (1 + np.exp(-bias))
        above = z >= bias
        over = np.where(above, np.logaddexp(0, z) - quiet, 0.0)
        total = quiet + np.bincount(bag_of, over, len(bags))  # -log(1 - score)
        slope = np.where(y == 1, np.maximum(-1 / np.expm1(np.clip(total, 1e-6, 50)), -50.0), 1.0) * each
        p = 1 / (1 + np.exp(-z))
        of_bias = slope.sum() * base + (slope[bag_of] * (p - base))[above].sum()
        g = np.append(np.bincount(feats, (slope[bag_of] * p * above)[sent_of], len(used)), of_bias)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        w = w - move[:-1]
        bias = min(-3.0, bias - 0.2 * move[-1])
        w = np.sign(w) * np.maximum(np.abs(w) - 0.01, 0)
    weights[used] = w
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Fit on the bounded sample; its features, not its texts, come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for x in batch.column(1):
                bags.append([sorted({f for w in ws for f in features(w)}) for _, _, ws in sentences(x.as_py() or "")])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int32()), pa.array(bags, pa.list_(pa.list_(pa.int32())))], names=["y", "bags"]
            )

    sample = training_sample(docs, labels).mapInArrow(run, "y int, bags array<array<int>>")
    return fit([(r["y"], r["bags"]) for r in sample.collect()])


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float], *, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_offending, worst_start, worst_end.

    NULL and empty texts are scored as one empty sentence; ``n_offending``
    counts the sentences with a probability of one half or more, and the worst
    one's place is in code points.  Repeated rows are scored each; a NULL
    doc_id is never held out; other columns are ignored; an empty table gives no rows.
    """
    weights, bias = model
    # Only features that weigh anything are sent: a dictionary of at most 2**BITS entries.
    weighed = {int(i): float(weights[i]) for i in np.flatnonzero(weights)}
    shared = docs.sparkSession.sparkContext.broadcast(weighed)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        table = shared.value
        for batch in batches:
            scores, counts, starts, ends = [], [], [], []
            for x in batch.column(1):
                total, n, worst, place = quiet, 0, -1e9, (0, 0)
                for s, e, ws in sentences(x.as_py()):
                    hits: set[int] = set()
                    for w in ws:
                        fs = known.get(w)
                        if fs is None:
                            if len(known) >= CACHED_WORDS:
                                known.clear()
                            fs = known[w] = [f for f in features(w) if f in table]
                        if fs:
                            hits.update(fs)
                    z = min(30.0, max(-30.0, bias + sum(table[f] for f in sorted(hits))))
                    if z > bias:
                        total += float(np.log1p(np.exp(z))) - quiet
                    n += z >= 0
                    if z > worst:
                        worst, place = z, (s, e)
                scores.append(float(-np.expm1(-total)))
                counts.append(n)
                starts.append(place[0])
                ends.append(place[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())] + [pa.array(c, pa.int64()) for c in (counts, starts, ends)],
                names=["doc_id", "score", "n_offending", "worst_start", "worst_end"],
            )

    quiet = float(np.log1p(np.exp(bias)))
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, n_offending long, worst_start long, worst_end long"
    )
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_offending", "worst_start", "worst_end",
    )
