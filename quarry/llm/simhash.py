"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Fingerprints first collapse to distinct values.  Each distinct value is dealt out
by its four 16-bit blocks: two fingerprints that differ in at most three bits
agree in at least one block, so every link lies within a block's bucket.  A
bucket with more than ``bucket_rows`` fingerprints is dealt out again by four
blocks of the bits that its key doesn't fix, and so on, until no bucket is too large;
bits are used up on the way, so a bucket is bounded whatever the data are.

Within a task the buckets are sorted by Gray rank and indexed: a leaf is a run of
neighbours in Gray order, its node keeps the bits they all share as (mask, pattern),
upper nodes keep what their children share, children only what is left.  A search
walks down with the differences added up so far and drops a whole group
as soon as they exceed the radius, or once the group already is in the
searcher's component.  A task returns a forest, never all pairs; components over
all tasks come from alternating large and small stars on written tables.

Defined results: rows that share an id are one document, so what one of them links to
is linked to the others, and an id has one component; rows without an id are linked by their
texts like any other, but are nobody's smallest id, so a component of such rows alone is null;
null texts count as empty; an empty text has fingerprint zero and links like any other; equal
rows share a fingerprint and so a component; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import apart, drop_path, in_arrow, shared_path, stored

SEED, BITS, FAN = 42, 64, 16
ONE = np.uint64(1)


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of the word shingles of ``text``, 0 without words."""
    found = text.lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    n = len(found)
    if not n:
        return 0
    joined = b" ".join(found)
    if n <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: n - words + 1].tolist(), (ends[words - 1 :] - 1).tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, n - words + 1)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp long) for each row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.fromiter((fingerprint(t.as_py(), words) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got.view(np.int64))], ["id", "fp"])

    return in_arrow(rows, run, "id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in the Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class HierarchicalIndex:
    """Index of Gray-sorted codes; ``roots`` says which bucket each code is in.

    Level 0 holds the codes, level k nodes of up to FAN nodes of level k - 1,
    never across buckets; the top nodes are the buckets' heads.
    """

    def __init__(self, codes: np.ndarray, roots: np.ndarray):
        self.codes = codes
        levels = [(codes, np.full(len(codes), ~np.uint64(0)), roots, np.arange(len(codes)), np.arange(len(codes)) + 1)]
        while True:
            pattern, mask, root, _, _ = levels[-1]
            n = len(pattern)
            change = np.flatnonzero(np.concatenate(([True], root[1:] != root[:-1])))
            if len(change) == n:
                break
            within = np.arange(n) - np.repeat(change, np.diff(np.append(change, n)))
            first = np.flatnonzero(within % FAN == 0)
            last = np.append(first[1:], n)
            base = np.repeat(pattern[first], last - first)
            differ = np.bitwise_or.reduceat((pattern ^ base) | ~mask, first)
            levels.append((pattern[first], ~differ, root[first], first, last))
        self.levels = levels

    def search(self, radius: int, labels: np.ndarray, block: int = 2048) -> np.ndarray:
        """Components of codes linked within ``radius`` and within buckets, as the
        smallest position of each, merged into ``labels`` (changed in place)."""
        for query, node in self.near(radius, labels, block):
            merge_labels(labels, query, node)
        return labels

    def near(self, radius: int, labels: np.ndarray, block: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions within ``radius`` and within buckets whose labels differ, by blocks of
        searchers; labels that the caller changes count from the next block on."""
        top = len(self.levels) - 1
        heads = self.levels[top][2]
        own = np.searchsorted(heads, self.levels[0][2])
        for at in range(0, len(self.codes), block):
            query = np.arange(at, min(at + block, len(self.codes)))
            node, spent = own[query], np.zeros(len(query), np.int64)
            above = np.zeros(len(query), np.uint64)  # bits that the parents have counted
            same = self._uniform(labels)
            for level in range(top, -1, -1):
                pattern, mask, _, first, last = self.levels[level]
                left = mask[node] & ~above
                spent = spent + np.bitwise_count((self.codes[query] ^ pattern[node]) & left)
                keep = (spent <= radius) & (same[level][node] != labels[query])
                query, node, spent = query[keep], node[keep], spent[keep]
                if level == 0:
                    yield query, node
                    break
                below = self.levels[level][3][node], self.levels[level][4][node]
                above = mask[node]
                width = below[1] - below[0]
                step = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                query, spent, above = np.repeat(query, width), np.repeat(spent, width), np.repeat(above, width)
                node = np.repeat(below[0], width) + step

    def _uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """For each node the component all its codes are in, or -1."""
        out = [labels]
        for _, _, _, first, _ in self.levels[1:]:
            low, high = np.minimum.reduceat(out[-1], first), np.maximum.reduceat(out[-1], first)
            out.append(np.where(low == high, low, -1))
        return out


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the components of a[i] and b[i]; labels stay the smallest member's position."""
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:  # roots point to roots
            flat = labels[labels]
            if np.array_equal(flat, labels):
                break
            labels[:] = flat


def forest(codes: np.ndarray, roots: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (positions) of a star forest over the links within buckets."""
    order = np.lexsort((gray_rank(codes), roots))
    index = HierarchicalIndex(codes[order], roots[order])
    labels = index.search(radius, np.arange(len(codes)))
    member = np.flatnonzero(labels != np.arange(len(codes)))
    return order[labels[member]], order[member]


def _blocks(free: int, parts: int) -> list[int]:
    """Masks that cut the free bits of a 64-bit word into ``parts``, high bits first."""
    bits = [i for i in range(BITS - 1, -1, -1) if free >> i & 1]
    cut = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(distinct: DataFrame, *, radius: int = 3, bucket_rows: int = 20_000, task_rows: int = 100_000) -> DataFrame:
    """(a, b): ids of a forest that joins all of (id, fp) within ``radius`` bits,
    ids being unique per fingerprint."""
    spark = distinct.sparkSession
    work, free, done = distinct.select("id", "fp", F.lit(0).cast("long").alias("mask")), [(0, (1 << BITS) - 1)], []
    while True:
        # One row per block of the bits still free: (mask of the key, key).
        masks = F.lit(None)
        choice = F.when(F.lit(False), F.array().cast("array<bigint>"))
        following = []
        for taken, rest in free:
            new = [taken | m for m in _blocks(rest, radius + 1) if m]
            following += [(m, ((1 << BITS) - 1) & ~m) for m in new]
            choice = choice.when(F.col("mask") == _signed(taken), F.array(*[F.lit(_signed(m)).cast("long") for m in new]))
        dealt = work.select("id", "fp", F.explode(choice).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = dealt.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
        large = stored(sizes.where(F.col("n") > bucket_rows).select("mask", "key"), "large-buckets")
        free = [f for f in dict.fromkeys(following) if f[1]]
        if not free or large.isEmpty():
            done.append(dealt)
            break
        done.append(dealt.join(large, ["mask", "key"], "left_anti"))
        work = stored(dealt.join(large, ["mask", "key"], "left_semi").select("id", "fp", "mask"), "dealt-again")
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-distinct.count() * (radius + 1) // task_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        held = pa.Table.from_batches(found)
        mask, key = (held.column(c).to_numpy().view(np.uint64) for c in ("mask", "key"))
        _, roots = np.unique(np.column_stack([mask, key]), axis=0, return_inverse=True)
        ids, codes = held.column("id").to_numpy(), held.column("fp").to_numpy().view(np.uint64)
        a, b = forest(codes, roots.ravel(), radius)
        yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    return in_arrow(rows.repartition(parts, "mask", "key"), run, "a long, b long")


def joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges (smallest id, id) of a star forest with the components of the edges (a, b)."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    labels = np.arange(len(ids))
    merge_labels(labels, at[: len(a)], at[len(a) :])
    member = np.flatnonzero(labels != np.arange(len(ids)))
    return ids[labels[member]], ids[member]


def contracted(edges: DataFrame) -> DataFrame:
    """(a, b): each task's edges as a star forest, so no task returns more edges than it has ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if found:
            held = pa.Table.from_batches(found)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in joined(held.column("a").to_numpy(), held.column("b").to_numpy())], ["a", "b"])

    return in_arrow(edges.select("a", "b"), run, "a long, b long")


def components(edges: DataFrame, most_rounds: int = 60, task_edges: int = 250_000) -> DataFrame | None:
    """(id, component) for every id of ``edges`` (a, b): the smallest id reachable; None without an edge.

    Each round first contracts the edges within tasks of about ``task_edges`` (4 MB), then takes alternating large and small stars across them;
    edges that are one task's are settled by that.  Every round is a table in the shared folder, and the table of the round before is deleted.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).select(apart(F.col("a")).alias("a"), "m")
            out = both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("m").alias("a"), "b")
        else:  # a < b: hang b's smaller neighbours, and b, on the smallest of them
            low = e.groupBy("b").agg(F.min("a").alias("m"))
            joined = e.join(low.select(apart(F.col("b")).alias("b"), "m"), "b")
            out = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where(F.col("a") < F.col("b")).unionByName(low.select(F.col("m").alias("a"), "b"))
        return out.where(F.col("a") < F.col("b")).distinct()

    def mark(e: DataFrame) -> tuple:
        row = e.agg(F.count(F.lit(1)), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        return tuple(row)

    path = shared_path(spark, "edges")
    now = stored(edges.select("a", "b").where(F.col("a") != F.col("b")), "edges", path)
    before = mark(now)
    if not before[0]:
        return None
    for _ in range(most_rounds):
        tasks, fresh = -(-before[0] // task_edges), shared_path(spark, "edges")
        few = contracted(now.coalesce(tasks))
        now = stored(few if tasks == 1 else star(star(few, True), False), "edges", fresh)
        drop_path(spark, path)
        if tasks == 1:
            break  # one task has seen all edges
        path, after = fresh, mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components didn't settle")
    return now.select(F.col("b").alias("id"), F.col("a").alias("component"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """(id, fp, component_id) for each row; component_id is the smallest id reachable.

    The nodes are fingerprints.  Ids only come in as links between the fingerprints that
    one id has, and as the name of a component: its fingerprints' smallest id.
    """
    marked = stored(fingerprints(docs, id_col=id_col, text_col=text_col, words=words), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("id").alias("id")), "distinct-fingerprints")
    least = marked.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    several = stored(least.where(F.col("a") < F.col("b")).select("id", "a"), "ids-with-several")
    same_id = marked.join(several.select(apart(F.col("id")).alias("id"), "a"), "id").where(F.col("fp") > F.col("a")).select("a", F.col("fp").alias("b"))
    near = links(distinct.select(F.col("fp").alias("id"), "fp"), radius=radius)
    found = components(near.unionByName(same_id))
    if found is None:
        classes = distinct.select("fp", "id", F.col("fp").alias("component"))
    else:
        classes = distinct.join(found.withColumnRenamed("id", "fp"), "fp", "left").select("fp", "id", F.coalesce("component", "fp").alias("component"))
    classes = stored(classes, "fingerprint-classes")
    named = classes.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = classes.select("fp", "component").join(named.select(apart(F.col("component")).alias("component"), "component_id"), "component")
    return marked.join(classes.select("fp", "component_id"), "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex64(column: str):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
