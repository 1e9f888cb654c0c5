"""Near-duplicate embeddings by lattice hashing.

Each of ``TABLES`` random projections takes a unit vector to eight dimensions,
where it is decoded to the nearest point of the E8 lattice: its cell.  A vector
is a member of its own cell and probes the ``PROBES`` neighbouring cells (of
240) that its residual leans towards most.  Members are compared with every
member and prober of their cell, and a pair counts as a link when its cosine,
in double precision, reaches ``MIN_COSINE``.

Copies of one vector are one node.  A pair that meets in several cells is
counted in the first of them only, which a task tells from the two vectors
alone, so pairs are never written, shuffled or made distinct: a task returns
per node its number of links and one edge towards the least node it is
connected with there.  Cells over ``BLOCK_ROWS`` rows are cut into blocks and
compared block against block, in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import connected_components

MIN_COSINE = 0.9
TABLES = 6
PROBES = 8
CELL_SIZE = 1.3  # projected units per lattice unit; a pair at cosine 0.9 lies about 1.26 apart there
BLOCK_ROWS = 1024
SEED = 42
_CHUNK = 4096  # vectors hashed at a time
_PAIRS = 1 << 16  # links whose first cell is found at a time


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8, which lead to the neighbouring cells."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            found.append(v)
    found += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(found)


ROOTS = _roots()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    point = np.rint(x)
    off = x - point
    odd = np.flatnonzero(point.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point of each row: from D8, or from D8 moved by one half."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


@lru_cache(maxsize=8)
def _projections(dim: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((tables, dim, 8))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` added up in one fixed order, so that a row's result never depends on the rows beside it."""
    out = a[:, :1] * b[0]
    for k in range(1, len(b)):
        out += a[:, k : k + 1] * b[k]
    return out


def _mixed(cells: np.ndarray, start: int) -> np.ndarray:
    """A 64-bit key of lattice points (last axis) and a start value."""
    h = np.full(cells.shape[:-1], start, np.uint64)
    doubled = np.rint(2 * cells).astype(np.int64).view(np.uint64)
    for i in range(8):
        h = (h ^ doubled[..., i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def cell_keys(
    unit: np.ndarray, *, tables: int = TABLES, probes: int = PROBES, cell_size: float = CELL_SIZE, seed: int = SEED
) -> np.ndarray:
    """Keys of shape (vectors, tables, 1 + probes): a vector's own cell first, then those it probes."""
    n, dim = unit.shape
    keys = np.empty((n, tables, 1 + probes), np.int64)
    for at in range(0, n, _CHUNK):
        part = unit[at : at + _CHUNK]
        for t, matrix in enumerate(_projections(dim, tables, seed)):
            x = _product(part, matrix) / cell_size
            cell = nearest_e8(x)
            lean = _product(x - cell, ROOTS.T)
            near = np.argsort(-lean, axis=1, kind="stable")[:, :probes]
            around = np.concatenate([cell[:, None, :], cell[:, None, :] + ROOTS[near]], axis=1)
            keys[at : at + _CHUNK, t] = _mixed(around, dim * 1000 + t)
    return keys


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _payload(value, dtype: np.dtype) -> bytes | None:
    """The vector as bytes; None when it is NULL, empty, zero, or holds a NULL or non-finite component."""
    if not value.is_valid or len(value.values) == 0 or value.values.null_count:
        return None
    x = value.values.to_numpy().astype(dtype)
    return x.tobytes() if np.isfinite(x).all() and x.any() else None


def _vectors(payloads: pa.Array, dtype: np.dtype) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows by vector length: (positions, unit vectors)."""
    raw = payloads.to_pylist()
    sizes = np.array([len(x) for x in raw])
    return {
        int(n): (at := np.flatnonzero(sizes == n), units(np.frombuffer(b"".join(raw[i] for i in at), dtype).reshape(len(at), -1)))
        for n in np.unique(sizes)
    }


def _nodes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame, str]:
    """``rows(id, digest)`` with NULL digests for vectors without direction, ``nodes(node, digest, least, w, payload)``, and the type."""
    kind = "f8" if "double" in dict(vectors.dtypes)[vector_col] else "f4"
    cast = "array<double>" if kind == "f8" else "array<float>"
    id_type = dict(vectors.dtypes)[id_col]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.array([_payload(v, np.dtype(kind)) for v in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], names=["id", "payload"])

    slim = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(cast).alias("v"))
    rows = slim.mapInArrow(packed, f"id {id_type}, payload binary")
    rows = staged(rows.withColumn("digest", F.unhex(F.sha2("payload", 256))), "vectors")
    nodes = (
        rows.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min("id").alias("least"), F.count("*").alias("w"), F.first("payload").alias("payload"))
    )
    # Written once, so that a node keeps its number whatever runs again.
    return rows.select("id", "digest"), staged(nodes.withColumn("node", F.monotonically_increasing_id()), "vector-nodes"), kind


def _with_keys(nodes: DataFrame, kind: str, options: dict) -> DataFrame:
    """``(node, w, payload, keys)``: the keys of all tables in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys: list = [None] * batch.num_rows
            for at, unit in _vectors(batch.column(2), np.dtype(kind)).values():
                for i, row in zip(at, cell_keys(unit, **options).reshape(len(at), -1), strict=True):
                    keys[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))], names=["node", "w", "payload", "keys"])

    return nodes.select("node", "w", "payload").mapInArrow(run, "node bigint, w bigint, payload binary, keys array<bigint>")


def _owned(a: np.ndarray, b: np.ndarray, keys: np.ndarray, table: int, key: int) -> np.ndarray:
    """Whether (table, key) is the first cell in which nodes a and b (rows of ``keys``) are compared."""
    owner = np.zeros(len(a), bool)
    left = np.arange(len(a))
    for t in range(table + 1):
        ka, kb = keys[a[left], t], keys[b[left], t]
        at_a, at_b = (kb == ka[:, :1]).any(axis=1), (ka == kb[:, :1]).any(axis=1)
        if t == table:
            top = np.iinfo(np.int64).max
            first = np.minimum(np.where(at_a, ka[:, 0], top), np.where(at_b, kb[:, 0], top))
            owner[left[first == key]] = True
        left = left[~(at_a | at_b)]
    return owner


def _least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of the n rows that each row reaches over the pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compared(group: dict[str, np.ndarray], payloads: pa.Array, kind: str, min_cosine: float, options: dict) -> list[tuple[int, int, int]]:
    """Links of one cell (or pair of its blocks) owned by it: (node, weight of its links here, least node reached)."""
    left_row = group["member"] & (group["block"] == group["r"][0])
    right_row = group["block"] == group["c"][0]
    if not left_row.any() or len(left_row) < 2:
        return []
    order = np.argsort(group["node"], kind="stable")  # rows in node order, so that the least row is the least node
    payloads = payloads.take(pa.array(order))
    group = {name: column[order] for name, column in group.items()}
    left_row, right_row = left_row[order], right_row[order]
    (_, unit), = _vectors(payloads, np.dtype(kind)).values()
    left, right = np.flatnonzero(left_row), np.flatnonzero(right_row)
    near = unit[left] @ unit[right].T >= min_cosine
    i, j = np.nonzero(near)
    a, b = left[i], right[j]
    node, member = group["node"], group["member"]
    # Two members meet in both orders: counted when the smaller comes first.
    once = (node[a] < node[b]) | ((node[a] != node[b]) & ~member[b])
    a, b = a[once], b[once]
    if not len(a):
        return []
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    keys = cell_keys(unit[used], **options)
    cell = int(group["t"][0]), int(group["key"][0])
    own = np.concatenate([_owned(a[k : k + _PAIRS], b[k : k + _PAIRS], keys, *cell) for k in range(0, len(a), _PAIRS)])
    a, b = a[own], b[own]
    weight, node = group["w"][used], node[used]
    links = np.bincount(a, weight[b], len(used)) + np.bincount(b, weight[a], len(used))
    least = _least_reachable(len(used), a, b)
    return [(int(node[k]), int(links[k]), int(node[least[k]])) for k in np.flatnonzero(links)]


def _links(coded: DataFrame, kind: str, min_cosine: float, block_rows: int, options: dict) -> DataFrame:
    """``(node, links, least)`` partials of all cells."""
    width = options["probes"] + 1
    pos = F.posexplode("keys").alias("pos", "key")
    slots = coded.select("node", "w", "payload", pos)
    rows = slots.select("node", "w", "payload", "key", F.floor(F.col("pos") / width).cast("int").alias("t"), (F.col("pos") % width == 0).alias("member"))
    hot = coded.select(F.explode("keys").alias("hot_key")).groupBy("hot_key").agg(F.count("*").alias("n")).where(F.col("n") > block_rows)
    hot = staged(hot.select("hot_key", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")), "hot-cells")
    rows = rows.join(hot, F.col("key") == F.col("hot_key"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", block)
    # A member meets every block of its cell and is met by every block's members.
    all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    as_left = F.transform(all_blocks, lambda c: F.struct(F.col("block").alias("r"), c.alias("c")))
    as_right = F.transform(all_blocks, lambda r: F.struct(r.alias("r"), F.col("block").alias("c")))
    tasks = F.when(F.col("member"), F.array_union(as_left, as_right)).otherwise(as_right)
    dealt = rows.select("key", "t", "member", "block", "node", "w", "payload", F.explode(tasks).alias("task"))
    dealt = dealt.select("key", F.col("task.r").alias("r"), F.col("task.c").alias("c"), "t", "member", "block", "node", "w", "payload")
    dealt = dealt.repartition("key", "r", "c").sortWithinPartitions("key", "r", "c", "t")
    names = ["key", "r", "c", "t", "member", "block", "node", "w"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def results(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table | None]:
            cols = {c: rows.column(c).to_numpy() for c in names}
            payloads = rows.column("payload").combine_chunks()
            edge = np.flatnonzero(np.any([cols[c][1:] != cols[c][:-1] for c in ("key", "r", "c", "t")], axis=0)) + 1
            stops = [*edge.tolist(), rows.num_rows] if last else edge.tolist()
            out, start = [], 0
            for stop in stops:
                group = {c: x[start:stop] for c, x in cols.items()}
                out += _compared(group, payloads[start:stop], kind, min_cosine, options)
                start = stop
            parts = [pa.array([x[k] for x in out], pa.int64()) for k in range(3)]
            return pa.RecordBatch.from_arrays(parts, names=["node", "links", "least"]), rows.slice(start) if start < rows.num_rows else None

        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([batch])
            done, held = results(pa.concat_tables([held, rows]) if held is not None else rows, last=False)
            if done.num_rows:
                yield done
        if held is not None:
            yield results(held, last=True)[0]

    return dealt.mapInArrow(run, "node bigint, links bigint, least bigint")


def near_duplicate_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    min_cosine: float = MIN_COSINE,
    tables: int = TABLES,
    probes: int = PROBES,
    cell_size: float = CELL_SIZE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other rows whose vector has a cosine of at least
    ``min_cosine`` and was found; copies (also repeated rows) are found
    always.  ``component_id`` is the least id reachable over links, itself
    included, and ``kept`` tells whether that is the row's own id (false for a
    NULL id, true for each row that bears the least id).  A vector that is
    NULL, empty, zero, or holds a NULL or non-finite component links with
    nothing, nor do vectors of different lengths; other columns are ignored;
    an empty table gives no rows.
    """
    options = {"tables": tables, "probes": probes, "cell_size": cell_size}
    rows, nodes, kind = _nodes(vectors, id_col, vector_col)
    coded = staged(_with_keys(nodes, kind, options), "vector-cells")
    found = staged(_links(coded, kind, min_cosine, block_rows, options), "vector-links")
    counted = found.groupBy(F.col("node").alias("linked")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    classed = nodes.select("node", "digest", "least", "w").join(counted, F.col("node") == F.col("linked"), "left")
    roots = roots.select(F.col("node").alias("rooted"), "root")
    classed = classed.join(roots, F.col("node") == F.col("rooted"), "left").withColumn("root", F.coalesce("root", "node"))
    classed = staged(classed.select("digest", "least", "root", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector-classes")
    least = classed.groupBy("root").agg(F.min("least").alias("component_id"))
    classed = classed.join(least, "root").select(F.col("digest").alias("class_digest"), "n_links", "component_id")
    out = rows.join(classed, F.col("digest") == F.col("class_digest"), "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
