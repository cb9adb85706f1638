"""Exact k-means on integer vectors, with distances by matrix products.

Vectors become integers floor(``scale`` * x).  They are written as blocks of some thousand vectors in the narrowest integers that
hold them, so a round reads blocks and no rows.  A block's squared distances to all centroids are |x|^2 - 2 x.c + |c|^2, a float64 matrix product.
Every number on its way is an integer of at most dimension * (max |x| + max |c|)^2; where that is below 2^53 nothing is rounded,
whatever the order of additions.  The bound is taken vector by vector: those that exceed it go through 64-bit integers, below 2^63,
or else Python's integers, so results are the same everywhere.

A round is one job: ``treeAggregate`` over the blocks adds up counts and sums (k x dimension integers) in the tasks and then in
layers, so the driver gets a few kilobytes whatever the number of vectors, and hot vectors cost what others cost.  A lost executor's blocks are
read again.

Defined results: vectors that are null, of another dimension, or hold a null or non-finite component take no part and have no row;
vectors without an id are clustered like any other but begin no centroid; of rows that share an id each has its own row, and the
smaller vector comes first where they compete for a beginning; with fewer vectors than k there are so many centroids; ties go to the smaller number; distances
and inertias that a long can't hold are null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from quarry.llm.common import in_arrow, stored

EXACT, LONG = 1 << 53, 1 << 63
FORMS = ("<i2", "<i4", "<i8")


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python's where one needs more; scale is a power of two, so the product is exact."""
    scaled = np.floor(vectors.astype(np.float64) * scale)
    if not scaled.size or np.abs(scaled).max() < LONG / 2:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], object)


def packed(x: np.ndarray) -> tuple[str, bytes]:
    """A block's form and bytes; integers beyond 64 bits are pickled."""
    if x.dtype == object:
        return "big", pickle.dumps(x.tolist())
    most = int(np.abs(x).max()) if x.size else 0
    form = next(f for f in FORMS if most <= np.iinfo(f).max)
    return form, x.astype(form).tobytes()


def unpacked(form: str, raw: bytes, dimension: int) -> np.ndarray:
    if form == "big":
        return np.array(pickle.loads(raw), object).reshape(-1, dimension)
    return np.frombuffer(raw, form).reshape(-1, dimension).astype(np.int64)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (vectors, centroids): float64 products where they are exact, else integers."""
    dimension, top = x.shape[1], max((abs(int(c)) for c in centroids.ravel()), default=0)
    if x.dtype == object:
        size = np.array([max(map(abs, row), default=0) for row in x.tolist()], object)
        out = np.empty((len(x), len(centroids)), object)
    else:
        size = np.abs(x).max(1, initial=0)
        out = np.empty((len(x), len(centroids)), np.int64 if dimension * (int(size.max(initial=0)) + top) ** 2 < LONG else object)
    # int() before squaring: the bound itself must not overflow.
    limit = lambda most: (int(np.sqrt(most / dimension)) - 1) - top
    small = size < limit(EXACT)
    if small.any():
        a, c = x[small].astype(np.float64), centroids.astype(np.float64)
        out[small] = ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    rest = np.flatnonzero(~small)
    if len(rest):
        kind = np.int64 if x.dtype != object and dimension * (int(size[rest].max()) + top) ** 2 < LONG else object
        a, centres = x[rest].astype(kind), centroids.astype(kind)
        for k, c in enumerate(centres):
            d = a - c
            out[rest, k] = (d * d).sum(1)
    return out


@dataclass
class Totals:
    """Counts, sums and distances by cluster, in Python's integers between blocks."""

    counts: list[int]
    sums: list[list[int]]
    spread: list[int]

    @staticmethod
    def nothing(k: int, dimension: int) -> Totals:
        return Totals([0] * k, [[0] * dimension for _ in range(k)], [0] * k)

    def add(self, other: Totals) -> Totals:
        return Totals(
            [a + b for a, b in zip(self.counts, other.counts, strict=True)],
            [[a + b for a, b in zip(x, y, strict=True)] for x, y in zip(self.sums, other.sums, strict=True)],
            [a + b for a, b in zip(self.spread, other.spread, strict=True)],
        )


def totals_of(x: np.ndarray, centroids: np.ndarray) -> Totals:
    """The sums of one block; 64-bit ones where the block's size and numbers allow it."""
    found = distances(x, centroids)
    near = found.argmin(1) if len(x) else np.zeros(0, np.int64)  # the first of equal ones
    k = len(centroids)
    own = found[np.arange(len(x)), near]
    wide = x if x.dtype == object or not x.size or int(np.abs(x).max()) * len(x) < LONG else x.astype(object)
    far = own if own.dtype == object or not own.size or int(own.max()) * len(x) < LONG else own.astype(object)
    of = [near == j for j in range(k)]
    return Totals([int(m.sum()) for m in of], [[int(v) for v in wide[m].sum(0)] if m.any() else [0] * x.shape[1] for m in of], [int(far[m].sum()) if m.any() else 0 for m in of])


def moved(centroids: np.ndarray, totals: Totals) -> np.ndarray:
    """Componentwise floor(sum / count); an empty cluster's centroid stays."""
    rows = [[s // n for s in sums] if n else [int(v) for v in old] for old, n, sums in zip(centroids, totals.counts, totals.sums, strict=True)]
    return narrow(rows, centroids.shape[1])


def narrow(rows: list[list[int]], dimension: int) -> np.ndarray:
    big = any(abs(v) >= LONG // 2 for r in rows for v in r)
    return np.array(rows, object if big else np.int64).reshape(-1, dimension)


@dataclass(frozen=True)
class Clusters:
    """Final centroids and what they hold, a few numbers; ``blocks`` are the vectors."""

    centroids: np.ndarray
    totals: Totals
    blocks: DataFrame = field(repr=False)


def _blocks(rows: DataFrame, id_col: str, vector_col: str, dimension: int, scale: int) -> DataFrame:
    """(ids as long array, form, raw): the usable vectors of an Arrow batch each."""
    picked = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = b.column(1)
            lengths = cells.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            right = b.filter(pa.array(lengths == dimension))
            if not right.num_rows:
                continue
            values = right.column(1).flatten()
            whole = values.is_valid().to_numpy(zero_copy_only=False).reshape(-1, dimension).all(1)
            x = values.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, dimension)
            whole &= np.isfinite(x).all(1)
            if not whole.any():
                continue
            ids = right.column(0).filter(pa.array(whole))
            form, raw = packed(integers(x[whole], scale))
            yield pa.RecordBatch.from_arrays([pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([form]), pa.array([raw], pa.binary())], ["ids", "form", "raw"])

    return in_arrow(picked, run, "ids array<long>, form string, raw binary")


def _first(blocks: DataFrame, k: int, dimension: int, seed: str) -> np.ndarray:
    """The vectors whose id has the k smallest hashes; tasks send k candidates each batch of blocks, Spark keeps k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, tuple[int, ...]]] = []
        for b in batches:
            for ids, form, raw in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                marks = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), n) for n, i in enumerate(ids) if i is not None]
                low = sorted(marks)[k - 1 : k] or [("g",)]  # the k-th smallest; "g" is beyond all digits
                x = unpacked(form, raw, dimension)
                best = sorted([*best, *((m, tuple(int(v) for v in x[n])) for m, n in marks if m <= low[0][0])])[:k]
        yield pa.RecordBatch.from_arrays([pa.array([m for m, _ in best], pa.string()), pa.array([[str(v) for v in x] for _, x in best], pa.list_(pa.string()))], ["mark", "x"])

    # Ties of one id: by the components as numbers, which a decimal of 38 digits or the text of equal ones orders.
    rows = in_arrow(blocks, run, "mark string, x array<string>")
    numbers = F.transform("x", lambda v: F.struct(F.expr("0").alias("z"), v.cast("double").alias("d"), v.alias("s")))
    return narrow([[int(v) for v in r.x] for r in rows.orderBy("mark", numbers).limit(k).collect()], dimension)


def fit(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dimension: int = 64, k: int = 8, rounds: int = 10, scale: int = 1024, seed: str = "3") -> Clusters:
    """Centroids after ``rounds`` rounds from the k vectors with the smallest sha256 of ``seed:id``."""
    if scale < 1 or scale & (scale - 1):
        raise ValueError("scale must be a power of two")
    blocks = stored(_blocks(rows, id_col, vector_col, dimension, scale), "vector-blocks")
    centroids = _first(blocks, k, dimension, seed)
    spark = rows.sparkSession
    vectors = blocks.select("form", "raw").rdd

    def summed(now: np.ndarray) -> Totals:
        if not len(now):
            return Totals([], [], [])
        held, zero = spark.sparkContext.broadcast(now), Totals.nothing(len(now), dimension)
        got = vectors.treeAggregate(zero, lambda t, b: t.add(totals_of(unpacked(b.form, bytes(b.raw), dimension), held.value)), lambda a, b: a.add(b))
        held.destroy()
        return got

    for _ in range(rounds):
        fresh = moved(centroids, summed(centroids))
        if np.array_equal(fresh, centroids):
            break  # the rounds left would change nothing
        centroids = fresh
    return Clusters(centroids, summed(centroids), blocks)


def assigned(found: Clusters, id_col: str = "vec_id") -> DataFrame:
    """(id, cluster, distance) of every vector."""
    held, dimension = found.blocks.sparkSession.sparkContext.broadcast(found.centroids), found.centroids.shape[1]
    fits = lambda values: [int(v) if abs(int(v)) < LONG else None for v in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                x = unpacked(b.column(1)[at].as_py(), b.column(2)[at].as_py(), dimension)
                far = distances(x, held.value)
                near = far.argmin(1)
                own = far[np.arange(len(x)), near]
                own = pa.array(fits(own) if own.dtype == object else own, pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0)[at].values, pa.array(near.astype(np.int32)), own], [id_col, "cluster", "distance"])

    schema = StructType([StructField(id_col, LongType()), StructField("cluster", IntegerType()), StructField("distance", LongType())])
    return in_arrow(found.blocks, run, schema)


def cluster(rows: DataFrame, *, id_col: str = "vec_id", **options) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of every vector; the centroid is an array of decimal texts."""
    found = fit(rows, id_col=id_col, **options)
    out = assigned(found, id_col)
    fits = lambda v: F.lit(v if v < LONG else None).cast("long")
    spread = found.totals.spread
    by = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1) if values else F.lit(None)
    inertia = by([fits(s) for s in spread]).cast("long")
    centres = by([F.array(*[F.lit(str(v)) for v in c]) for c in found.centroids]).cast("array<string>")
    return out.select(id_col, "cluster", "distance", inertia.alias("cluster_inertia"), fits(sum(spread)).alias("inertia"), centres.alias("centroid"))
