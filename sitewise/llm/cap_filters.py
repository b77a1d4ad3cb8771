"""Embedding near-duplicates by spherical-cap filters.

The filter directions are a random product code: a rotated vector is cut into
BLOCKS parts, each part has its own list of random code words, and a filter
is one code word of each part.  All filters whose inner product with a vector
exceeds a bound are found by list decoding, walking the parts' sorted products
and never listing the code.  Two vectors at cosine THRESHOLD share a filter
nearly always; vectors that share one are compared exactly, in double
precision.  Equal vectors are one point from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, load, materialize

THRESHOLD = 0.9
BLOCKS = 2
FILTERS_EACH = 28  # filters a vector exceeds on average
PER_FILTER = 64  # points a filter holds on average
BLOCK_ROWS = 1024  # a filter with more points is compared block against block
SEED = 20_011

_POINTS = "vec_id long, point binary"


def unit(raw: np.ndarray) -> np.ndarray | None:
    """The vector in double precision at length 1, or None where it has none."""
    v = np.asarray(raw, np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v = v / top
    return v / np.sqrt(v @ v)


class Code:
    """The product code for vectors of one dimension."""

    def __init__(self, dim: int, n_points: int):
        rng = np.random.default_rng([SEED, dim])
        blocks = min(BLOCKS, dim)
        wanted = max(FILTERS_EACH * 2, n_points * FILTERS_EACH / PER_FILTER)
        size = max(2, math.ceil(wanted ** (1 / blocks)))
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.cuts = np.array_split(np.arange(dim), blocks)
        self.words = []
        for c in self.cuts:
            w = rng.normal(size=(size, len(c)))
            self.words.append(w / np.sqrt((w * w).sum(1, keepdims=True)))
        share = min(0.5, FILTERS_EACH / size ** blocks)
        # a filter has length sqrt(blocks); products of random vectors are about normal with variance 1 / dim
        self.bound = NormalDist().inv_cdf(1 - share) * math.sqrt(blocks / dim)

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for every filter a row exceeds, filters ascending in
        a row.  Each part extends only the partial sums that the best of the
        parts to come can still lift over the bound; a row that exceeds none
        gets its best filter."""
        rotated = vectors @ self.rotation
        products = [rotated[:, c] @ w.T for c, w in zip(self.cuts, self.words, strict=True)]
        best = [p.max(1) for p in products]
        bound = np.minimum(self.bound, sum(best))
        row, code, total = np.arange(len(vectors)), np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
        for k, p in enumerate(products):
            size = p.shape[1]
            to_come = sum(best[k + 1:], np.zeros(len(vectors)))
            order = np.argsort(-p, axis=1, kind="stable")
            falling = -np.take_along_axis(p, order, 1)
            need = (bound - to_come)[row] - total - 1e-12
            # how many of a row's sorted products are large enough, by one search over all rows
            shifted = falling + 4.0 * np.arange(len(p))[:, None]
            n = np.searchsorted(shifted.ravel(), np.clip(-need, -1.9, 1.9) + 4.0 * row, "right") - row * size
            n = np.clip(n, 0, size)
            at = np.repeat(np.arange(len(row)), n)
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            word = order[row[at], nth]
            total = total[at] + p[row[at], word]
            code = code[at] * size + word
            row = row[at]
        by = np.lexsort((code, row))
        return row[by], code[by]


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that can link, as doubles; -0 is 0."""
    for batch in batches:
        ids, out = [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if v is None or any(x is None for x in v):
                continue
            a = np.array(v, np.float64)
            if unit(a) is not None:
                ids.append(i)
                out.append((a + 0.0).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "point"])


def _filters(n_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Code] = {}
        for batch in batches:
            raw = batch.column(1).to_pylist()
            dims = np.array([len(b) // 8 for b in raw])
            for dim in np.unique(dims):
                code = codes.setdefault(int(dim), Code(int(dim), n_points))
                for some in np.array_split(np.flatnonzero(dims == dim), max(1, math.ceil((dims == dim).sum() / 512))):
                    row, flt = code.decode(np.stack([unit(np.frombuffer(raw[i])) for i in some]))
                    size = np.searchsorted(row, np.arange(len(some) + 1))
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(some)), pa.array([raw[i] for i in some], pa.binary()), batch.column(2).take(pa.array(some)),
                        pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(flt))], names=["pid", "point", "copies", "filters"])
    return run


def _column(batches: list[pa.RecordBatch], name: str):
    arr = pa.chunked_array([b.column(name) for b in batches]).combine_chunks()
    return arr if isinstance(arr, pa.Array) else arr.chunk(0)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (filter, dimension, pair of blocks); each group holds at
    most two blocks.  Whole groups are taken from the batches as arrays."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        rest.append(batch)
        keys = [c.to_numpy() for c in (batch.column(k) for k in ("flt", "dim", "lo", "hi"))]
        ends = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) if batch.num_rows else []
        if len(ends):
            cut = int(ends[-1]) + 1
            rest[-1] = batch.slice(0, cut)
            yield from _groups(rest)
            rest = [batch.slice(cut)]
    if rest:
        yield from _groups(rest)


def _groups(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flt, dim, lo, hi, part, pid, copies = (_column(batches, k).to_numpy() for k in ("flt", "dim", "lo", "hi", "part", "pid", "copies"))
    if not len(flt):
        return
    points, earlier = _column(batches, "point").cast(pa.large_binary()), _column(batches, "earlier")
    p_at = np.frombuffer(points.buffers()[1], np.int64)[points.offset:points.offset + len(points) + 1]
    raw = points.buffers()[2]
    e_at, e_all = earlier.offsets.to_numpy(), earlier.values.to_numpy()
    cut = np.flatnonzero((flt[1:] != flt[:-1]) | (dim[1:] != dim[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
    found = []
    for i, j in zip(np.append(0, cut), np.append(cut, len(flt)), strict=True):
        if j - i > 1:
            x = np.frombuffer(raw, np.float64, (p_at[j] - p_at[i]) // 8, p_at[i]).reshape(j - i, -1)
            found.append(_compare(x, part[i:j], int(lo[i]), int(hi[i]), pid[i:j], copies[i:j], e_at[i:j + 1], e_all))
    cols = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3)]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "n"])


def _compare(x, part, lo, hi, pid, copies, e_at, e_all):
    """(point, -1, links) and (root, point, 0) rows of one group.  A pair
    counts where its points share no earlier filter."""
    left, right = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
    x = x / np.abs(x).max(1, keepdims=True)
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    close = x[left] @ x[right].T >= THRESHOLD
    if lo == hi:
        close = np.triu(close, 1)
    if not close.any():
        return (np.zeros(0, np.int64),) * 3
    # points by the earlier filters they hold; a shared one owns the pair
    size = np.diff(e_at)
    flat = e_all[e_at[0]:e_at[-1]]
    if len(flat):
        names, col = np.unique(flat, return_inverse=True)
        row = np.repeat(np.arange(len(size)), size)
        for some in np.array_split(np.arange(len(names)), max(1, len(names) * len(size) // 4_000_000)):
            inside = (col >= some[0]) & (col <= some[-1])
            held = np.zeros((len(size), len(some)), np.float32)
            held[row[inside], col[inside] - some[0]] = 1
            close &= held[left] @ held[right].T == 0
    i, j = np.nonzero(close)
    i, j = left[i], right[j]
    uniq, at = np.unique(np.concatenate([pid[i], pid[j]]), return_inverse=True)
    total = np.bincount(at, np.concatenate([copies[j], copies[i]]), len(uniq)).astype(np.int64)
    a, b = _forest(np.minimum(pid[i], pid[j]), np.maximum(pid[i], pid[j]))
    return np.concatenate([uniq, a]), np.concatenate([np.full(len(uniq), -1), b]), np.concatenate([total, np.zeros(len(a), np.int64)])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest: every node with the root of its tree."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for p, q in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(p), find(q)
        if p != q:
            parent[max(p, q)] = min(p, q)
    pairs = [(find(x), x) for x in parent if find(x) != x]
    return np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)


def link(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Null, zero, empty or non-finite vectors, and those with null components,
    link with nothing; vectors of different lengths do not link; equal vectors
    link with each other whatever their number, without being paired.  Rows
    that repeat an id count as vectors of their own.  An empty table gives an
    empty result.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    points = materialize(rows.mapInArrow(_points, _POINTS))
    distinct = points.groupBy("point").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    distinct = materialize(distinct.withColumn("pid", F.monotonically_increasing_id()))
    listed = materialize(distinct.select("pid", "point", "copies").mapInArrow(_filters(distinct.count()), "pid long, point binary, copies long, filters array<long>"))
    # only filters that hold two points or more carry vectors on
    member = listed.select("pid", F.length("point").alias("dim"), F.explode("filters").alias("flt"))
    held = member.groupBy("flt", "dim").agg(F.count("*").alias("m")).where("m > 1").select(F.col("flt").alias("f"), F.col("dim").alias("d"), F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("k"))
    member = listed.select("pid", "point", "copies", "filters", F.length("point").alias("dim"), F.explode("filters").alias("flt"))
    member = member.join(held, (F.col("flt") == F.col("f")) & (F.col("dim") == F.col("d"))).drop("f", "d")
    member = member.withColumn("part", F.pmod(F.xxhash64("pid"), "k").cast("int"))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    member = member.select("flt", "dim", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "pid", "point", "copies", F.filter("filters", lambda f: f < F.col("flt")).alias("earlier"))
    found = member.repartition("flt", "dim", "lo", "hi").sortWithinPartitions("flt", "dim", "lo", "hi", "pid").mapInArrow(_pairs, "a long, b long, n long")
    found = materialize(found)
    links = found.where("b < 0").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "l_pid")
    comp = components(found.where("b >= 0").select("a", "b"))
    named = distinct.select("pid", "point", "copies", "least").join(comp, F.col("pid") == F.col("node"), "left").join(links, F.col("pid") == F.col("l_pid"), "left")
    named = materialize(named.select("point", "copies", "least", F.coalesce("component", "pid").alias("root"), F.coalesce("n", F.lit(0)).alias("n")))
    heads = named.groupBy("root").agg(F.min("least").alias("head")).withColumnRenamed("root", "r")
    named = named.join(heads, F.col("root") == F.col("r")).select(F.col("point").alias("p"), (F.col("n") + F.col("copies") - 1).alias("n_links"), "head")
    linked = points.join(named, F.col("point") == F.col("p")).select("vec_id", F.col("n_links").cast("long").alias("n_links"), F.coalesce("head", "vec_id").alias("component_id"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    alone = rows.where(~F.coalesce(finite, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(load(spark, sf_dir, "embeddings"))
