"""Lattice hashing against brute force: all cosines, components, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import ORACLE_SF
from tripmart.llm import embedding_dedup as e8
from tripmart.llm.common import table


def slow(ids, vectors):
    """(n_links, component) of each row by all cosines."""
    ok = [i for i, v in enumerate(vectors) if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    links = np.zeros((len(ids), len(ids)), bool)
    for n in {len(vectors[i]) for i in ok}:
        at = [i for i in ok if len(vectors[i]) == n]
        x = np.array([vectors[i] for i in at], np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        norm = np.linalg.norm(x, axis=1)
        links[np.ix_(at, at)] = (x @ x.T) / np.outer(norm, norm) >= e8.MIN_COSINE - 1e-15
    np.fill_diagonal(links, False)
    label = np.array(ids)
    while True:
        new = np.array([min(label[i], *label[links[i]]) if links[i].any() else label[i] for i in range(len(ids))])
        if (new == label).all():
            return links, label
        label = new


def clustered(rng, sizes, spread, dim=64):
    out = []
    for n in sizes:
        centre = rng.normal(size=dim)
        out += [centre / np.linalg.norm(centre) + spread * rng.normal(size=dim) / np.sqrt(dim) for _ in range(n)]
    return np.array(out, np.float32)


def test_decoder_is_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 8)) * 2
    point = e8.nearest_e8(x)
    gap = ((x - point) ** 2).sum(axis=1)
    around = ((x[:, None, :] - (point[:, None, :] + e8.ROOTS)) ** 2).sum(axis=2).min(axis=1)
    assert len(e8.ROOTS) == 240 and (gap <= around + 1e-12).all() and gap.max() <= 1 + 1e-9  # covering radius 1
    assert ((2 * point).sum(axis=1) % 4 == 0).all()


@pytest.mark.parametrize("block_rows", [8, e8.BLOCK_ROWS])
def test_links_and_components(spark, block_rows):
    rng = np.random.default_rng(2)
    x = clustered(rng, [60, 1, 30, 1, 5, 2] + [1] * 60, 0.2)
    ids = rng.permutation(len(x)).tolist()
    links, label = slow(ids, x.tolist())
    rows = spark.createDataFrame(list(zip(ids, x.tolist(), strict=True)), "vec_id long, embedding array<float>")
    rows = rows.withColumns({"label": F.lit(1), "node": F.lit(5), "key": F.lit("clash")})
    got = {r.vec_id: r for r in e8.near_duplicate_vectors(rows, block_rows=block_rows).collect()}
    for i, n in enumerate(ids):
        assert (got[n].n_links, got[n].component_id, got[n].kept) == (links[i].sum(), label[i], n == label[i])


def test_recall_at_the_threshold_and_no_false_links(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    w = rng.normal(size=a.shape)
    w -= (w * a).sum(axis=1, keepdims=True) * a
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    cos = rng.uniform(0.88, 0.93, size=(len(a), 1))
    x = np.concatenate([a, cos * a + np.sqrt(1 - cos**2) * w])
    links, _ = slow(list(range(len(x))), x.tolist())
    rows = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = sorted(e8.near_duplicate_vectors(rows).collect())
    want = links.sum(axis=1)
    assert all(r.n_links <= n for r, n in zip(got, want, strict=True))
    assert sum(r.n_links for r in got) >= 0.98 * want.sum() > 1000


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(5, v), (3, v), (3, v), (9, [2e300, 4e300, 6e300, 8e300]), (8, None), (7, [0.0] * 4), (6, [0.0] * 4), (4, [1.0, None, 3.0, 4.0]),
            (2, [1.0, float("nan"), 0.0, 1.0]), (1, [float("inf")] * 4), (0, []), (10, [1.0, 2.0, 3.0]), (None, v), (None, None),
            (11, [1e-310, 2e-310, 3e-310, 4e-310]), (12, [-1.0, -2.0, -3.0, -4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted([tuple(r) for r in e8.near_duplicate_vectors(df).collect()], key=str)
    alone = [(i, 0, i, True) for i in (0, 1, 2, 4, 6, 7, 8, 10, 12)]
    want = alone + [(3, 5, 3, True)] * 2 + [(5, 5, 3, False), (9, 5, 3, False), (11, 5, 3, False), (None, 5, 3, False), (None, 0, None, False)]
    assert got == sorted(want, key=str)
    assert e8.near_duplicate_vectors(df.limit(0)).collect() == []


def test_given_table(spark):
    rows = table(spark, ORACLE_SF, "embeddings")
    data = rows.orderBy("vec_id").collect()
    links, label = slow([r.vec_id for r in data], [r.embedding for r in data])
    got = sorted(e8.near_duplicate_vectors(rows).collect())
    assert [(r.n_links, r.component_id) for r in got] == list(zip(links.sum(axis=1).tolist(), label.tolist(), strict=True))
