"""Nearest neighbours by additive quantisation.

A vector is the sum of one word from each of several full-dimensional codebooks.
The books are trained one after another on what the books before leave over, on
a sample of at most ``sample_rows`` vectors; every vector is then encoded by a beam
search over all books, and the squared norm of what its codes decode to is stored with them.  A
search adds up table look-ups of the codes (with those norms where the measure needs
them), takes the ``rerank`` best of each ``block_rows`` index rows and scores those exactly, in
double precision, on the original vectors.

All rows are indexed and all are scored.  The index stays where it is written: the queries, in
slices of about ``slice_rows``, are sent to its tasks, and a task returns its best ``k`` for each of them.
So neither codes nor vectors are shuffled or copied for a search.  Equal vectors are indexed once with
their smallest ids, so copies of one vector can't crowd out the others.

Defined results: vectors that are null, zero, hold a null or non-finite component,
or have another dimension than most, take no part; ties go to the smaller id; with
fewer candidates than ``k`` all are returned; other columns are not read, so their names can't clash; an id that occurs twice is a
candidate twice, and neither row is its own neighbour; a query id with several vectors
asks with the least of them; null ids take no part; an empty table has no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quarry.llm.common import in_arrow, shared_path, stored
from quarry.session import spread


@dataclass(frozen=True)
class Codebooks:
    books: np.ndarray  # (books, words, dimensions), float32

    def encode(self, vectors: np.ndarray, beam: int = 4, block: int = 2048) -> np.ndarray:
        return np.concatenate([self._encode(vectors[i : i + block], beam) for i in range(0, len(vectors), block)] or [np.zeros((0, len(self.books)), np.uint8)])

    def _encode(self, x: np.ndarray, beam: int) -> np.ndarray:
        n, (_, words, _) = len(x), self.books.shape
        rest = x[:, None, :].astype(np.float32)  # (rows, beam, dimensions)
        codes = np.zeros((n, 1, 0), np.uint8)
        for book in self.books:
            width = rest.shape[1]
            # |r - c|^2 for every kept residual and word
            cost = (rest * rest).sum(2)[:, :, None] - 2 * (rest.reshape(n * width, -1) @ book.T).reshape(n, width, words) + (book * book).sum(1)
            cost = cost.reshape(n, width * words)
            keep = min(beam, cost.shape[1])
            best = np.argpartition(cost, keep - 1, axis=1)[:, :keep]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(cost, best, 1), axis=1, kind="stable"), 1)
            old, word = best // words, best % words
            codes = np.concatenate((np.take_along_axis(codes, old[:, :, None], 1), word[:, :, None].astype(np.uint8)), 2)
            rest = np.take_along_axis(rest, old[:, :, None], 1) - book[word]
        return codes[:, 0]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(book[codes[:, m]] for m, book in enumerate(self.books))

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(books, words, queries): the share of each word in the inner product."""
        return np.ascontiguousarray(self.books @ queries.T.astype(np.float32))


def train(sample: np.ndarray, books: int = 32, words: int = 256, rounds: int = 8, seed: int = 0) -> Codebooks:
    rng = np.random.default_rng(seed)
    rest, found = sample.astype(np.float32).copy(), []
    words = min(words, max(1, len(sample)))
    for _ in range(books):
        book = rest[rng.choice(len(rest), words, replace=False)].copy()
        for _ in range(rounds):
            near = (-2 * rest @ book.T + (book * book).sum(1)).argmin(1)
            many = np.bincount(near, minlength=words)
            order = np.argsort(near, kind="stable")
            full = np.flatnonzero(many)
            book[full] = np.add.reduceat(rest[order], np.cumsum(many)[full] - many[full], axis=0) / many[full, None]
        near = (-2 * rest @ book.T + (book * book).sum(1)).argmin(1)
        rest -= book[near]
        found.append(book)
    return Codebooks(np.stack(found))


def sound(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<float or double>) of the rows that take part."""
    v = F.col(vector_col)
    kind = "double" if isinstance(rows.schema[vector_col].dataType.elementType, DoubleType) else "float"
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)
    out = rows.select(F.col(id_col).cast("long").alias("id"), v.cast(f"array<{kind}>").alias("v"), good.alias("good"), F.size(v).alias("n"))
    out = out.where(F.col("good") & F.col("id").isNotNull())
    common = out.groupBy("n").count().orderBy(F.desc("count"), "n").head()
    return out.where(F.col("n") == (common.n if common else 0)).select("id", "v")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column whose lists have one length."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def build(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", copies: int = 21, books: int = 32, words: int = 256, beam: int = 4, sample_rows: int = 20_000) -> tuple[DataFrame, Codebooks | None]:
    """The index (v, ids, codes, norm), one row per distinct vector with its
    ``copies`` smallest ids, and the codebooks."""
    valid = sound(rows, id_col, vector_col)
    near = Window.partitionBy("v").orderBy("id")
    members = valid.withColumn("r", F.row_number().over(near)).where(F.col("r") <= copies)
    distinct = members.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # at most ``copies``
    sample = valid.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()  # bounded
    if not sample.num_rows:
        return distinct.withColumn("codes", F.lit(b"")).withColumn("norm", F.lit(0.0)), None
    model = train(matrix(sample.column(0)), books, words)
    held = rows.sparkSession.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                codes = held.value.encode(matrix(b.column(0)), beam)
                norm = (held.value.decode(codes).astype(np.float64) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm)], ["v", "ids", "codes", "norm"])

    index = in_arrow(spread(distinct), encode, distinct.withColumns({"codes": F.lit(b""), "norm": F.lit(0.0)}).schema)
    return stored(index, "additive-index"), model


def measure(metric: str, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact measure of query rows (n, d) with candidates (n, r, d)."""
    if metric == "l2":
        return -((q[:, None, :] - x) ** 2).sum(2)
    dot = np.einsum("nd,nrd->nr", q, x)
    return dot if metric == "ip" else dot / np.sqrt((q * q).sum(1)[:, None] * (x * x).sum(2))


def rough(metric: str, tables: np.ndarray, codes: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Look-up scores (queries, rows)."""
    got = np.zeros((len(codes), tables.shape[2]), np.float32)
    for book, word in zip(tables, codes.T, strict=True):
        got += book[word]
    if metric == "cosine":
        got /= np.sqrt(np.maximum(norm, 1e-30)).astype(np.float32)[:, None]
    elif metric == "l2":
        got = 2 * got - norm.astype(np.float32)[:, None]
    return got.T


class Best:
    """The ``width`` best index rows so far of each query, ties by the smallest id."""

    def __init__(self, queries: int, width: int):
        self.score = np.full((queries, width), -np.inf)
        self.low = np.full((queries, width), np.iinfo(np.int64).max)
        self.ids = np.full((queries, width), None, object)

    def add(self, at: slice, score: np.ndarray, low: np.ndarray, ids: np.ndarray) -> None:
        score, low, ids = (np.concatenate(x, axis=1) for x in ((self.score[at], score), (self.low[at], low), (self.ids[at], ids)))
        order = np.lexsort((low, -score))[:, : self.score.shape[1]]
        self.score[at], self.low[at], self.ids[at] = (np.take_along_axis(x, order, 1) for x in (score, low, ids))


def search(
    index: DataFrame,
    model: Codebooks | None,
    queries: DataFrame,
    *,
    k: int = 20,
    rerank: int = 256,
    block_rows: int = 16_384,
    slice_rows: int = 16_384,
    metric: str = "ip",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each query (id, v), but not itself.

    ``metric``: ip (inner product), cosine, or l2 (negative squared distance).  The driver passes on
    one slice of queries at a time; a slice is one broadcast and one scan of the index, whose result is written before the next.
    """
    spark = index.sparkSession
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books = spark.sparkContext.broadcast(model)
    asking = stored(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")
    slices = max(1, -(-asking.count() // slice_rows))

    def scan(held) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, vectors = held.value
            best, block, size = Best(len(asked), k + 1), [], 0  # one more: the query's own vector may have no other member

            def settle() -> None:
                rows = pa.Table.from_batches(block)
                x, norm, members = matrix(rows.column("v")), rows.column("norm").to_numpy(), np.empty(rows.num_rows, object)
                members[:] = rows.column("ids").to_pylist()
                low = np.fromiter((m[0] for m in members), np.int64, len(members))
                codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(len(x), -1)
                most = min(rerank, len(x))
                for i in range(0, len(asked), 128):
                    at = slice(i, min(i + 128, len(asked)))
                    scores = rough(metric, books.value.tables(vectors[at]), codes, norm)
                    near = np.argpartition(-scores, most - 1, axis=1)[:, :most]
                    best.add(at, measure(metric, vectors[at].astype(np.float64), x[near].astype(np.float64)), low[near], members[near])

            for b in batches:
                for i in range(0, b.num_rows, block_rows):
                    part = b.slice(i, block_rows)
                    if size + part.num_rows > block_rows:
                        settle()
                        block, size = [], 0
                    block.append(part)
                    size += part.num_rows
            if size:
                settle()
            full = best.score > -np.inf
            query = np.repeat(asked, full.sum(1))
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(best.ids[full].tolist(), pa.list_(pa.int64())), pa.array(best.score[full])], ["query_id", "ids", "score"])

        return in_arrow(index, run, "query_id long, ids array<long>, score double")

    path, written, found = shared_path(spark, "found"), 0, None
    for s in range(slices):
        part = asking.where(F.pmod(F.xxhash64("id"), F.lit(slices)) == s).toArrow()  # about slice_rows rows
        if not part.num_rows:
            continue
        held = spark.sparkContext.broadcast((part.column("id").to_numpy(), matrix(part.column("v"))))
        if slices == 1:
            found = scan(held)
        else:  # one slice at a time is held anywhere, and the plan doesn't grow with their number
            stored(scan(held), "found", f"{path}/slice={s}")
            held.destroy()
            written += 1
    if written:
        found = spark.read.schema("query_id long, ids array<long>, score double").parquet(f"{path}/slice=*")
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rows = found.select("query_id", F.explode("ids").alias("vec_id"), "score").where(F.col("vec_id") != F.col("query_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(rows: DataFrame, is_query, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, **options) -> DataFrame:
    """Index all ``rows`` and search those for which ``is_query`` (of column id) holds."""
    build_options = {n: options.pop(n) for n in ("books", "words", "beam", "sample_rows") if n in options}
    index, model = build(rows, id_col=id_col, vector_col=vector_col, copies=k + 1, **build_options)
    queries = sound(rows, id_col, vector_col).where(is_query(F.col("id")))
    return search(index, model, queries, k=k, **options)
