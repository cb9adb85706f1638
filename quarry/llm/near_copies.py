"""Near copies: rows whose sets of five-word shingles are alike by 0.8 (Jaccard) or more.

Rows with equal sets are one class.  Classes are compared by SimHash: a fingerprint of ``BITS`` bits, each the majority
of one hash bit over the set.  Two sets alike by 0.8 differ in 15 % of the bits, in no case in more than a sixth (four
shingles of five: 3/16), unrelated ones in half of them.  What keeps three bits of 64 apart deals out by blocks (:mod:`quarry.llm.simhash`);
a sixth leaves no block untouched.  So each of a number of tables picks a few of the bits, and rows that agree on them are a
bucket; the bits of a key grow with the logarithm of the rows, so that a bucket has at most about ``bucket_rows``, and
there are as many tables as let a pair that differs in a sixth of its bits meet in none with a probability of MISS.
Few tables of large buckets move fewer rows than many of small ones.
Within a bucket all pairs are compared: those within ``radius`` of the first 64 bits and FAR of 192, of sizes
that 0.8 allows and of parities that allow it are left, and verified on the sets themselves, so no link is a guess.

Parities are exact: of the ODD slots that a set's shingles fall in, those that hold an odd number are marked.  Two sets have at least
as many shingles that only one of them has as there are slots marked for one alone, so what this drops is below 0.8 for certain.

First comes a turn with PIVOT_TABLES tables of small buckets (``pivots`` such turns), where the Gray-ordered hierarchical index finds for
each row the nearest of another cluster and makes them one, so a large group of near copies costs its size.  Then all pairs
of all tables follow that are still apart.  Where those are many for a bucket's rows (documents of one template that aren't near copies),
its rows are not paired but dealt out by their rarest shingles, which no pair at 0.8 can miss, and buckets of more
than SMALL of such rows are verified where their members meet, in blocks.

Defined results: null texts count as empty; texts of at most five words are one shingle;
texts without words are equal; an empty table gives an empty result; keys must be unique.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import apart, dropped_after, in_arrow, shared_path, stored
from quarry.llm.simhash import HierarchicalIndex, components, gray_rank, joined, merge_labels

SEED, BITS, ODD, MISS = 42, 1024, 1024, 1e-6
SIXTH, SHORT, SHORT_SIXTH = 1 / 6, 5, 3 / 16  # most bits that sets alike by 0.8 differ in; sets of at most SHORT shingles
MOST_KEY_BITS, MOST_TABLES, SPREAD_BITS = 20, 1024, 5  # SPREAD_BITS deal out buckets to many tasks where rows are few
PIVOT_TABLES, PIVOT_ROWS, SLICE, FEW = 16, 64, 8, 500_000  # tables and bucket rows of a turn with pivots; tables that are shuffled at a time; rows whose keys are broadcast to the texts
NEAR, FAR = 12, 60  # bits of 64 within which a pivot turn looks; most bits of 192 that a pair at 0.8 differs in
TASK_ROWS, INDEX_ROWS, DENSE = 50_000, 32_768, 8  # dealt rows of a task; rows of an index; pairs a row beyond which a bucket is dealt out by shingles
PAIRS, CELLS = 500_000, 1 << 17  # pairs of a searcher and a node held at a time; pairs of a bucket's rows compared at a time
SMALL, BLOCK, WIDE = 64, 1024, 4096  # rows of a bucket whose pairs become rows; rows of a block; columns at a time
_DRAWN = np.random.default_rng(SEED)
_WORDS = _DRAWN.integers(0, 1 << 64, BITS // 64, dtype=np.uint64)
_PICKED = np.argsort(_DRAWN.random((MOST_TABLES, BITS)), axis=1)[:, :MOST_KEY_BITS]  # bits of the tables' keys
_MIX, _HALF = np.uint64(0x9E3779B97F4A7C15), np.uint64(32)


def _mixed(held: np.ndarray, more: np.ndarray) -> np.ndarray:
    x = (held ^ more) * _MIX
    return (x ^ (x >> _HALF)) * _MIX


def shingles(text: bytes, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ``text``."""
    found = text.lower().split()  # as in simhash.fingerprint
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    if n <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), SEED)], np.uint64)
    codes = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, n)
    held = np.full(n - words + 1, SEED, np.uint64)
    for k in range(words):
        held = _mixed(held, codes[k : k + len(held)])
    return np.unique(held ^ (held >> _HALF))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def signature(found: np.ndarray) -> bytes:
    """SimHash of a set of shingles."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(found), 255):  # as many as a byte counts
        mixed = _mixed(found[at : at + 255, None], _WORDS)
        counts += np.add.reduce(np.unpackbits((mixed ^ (mixed >> _HALF)).view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(found)).tobytes()


def parities(found: np.ndarray) -> bytes:
    """A bit for each of ODD slots: whether an odd number of the set's shingles falls in it."""
    return np.packbits(np.bincount((found & np.uint64(ODD - 1)).astype(np.int64), minlength=ODD).astype(np.uint8) & 1).tobytes()


def signatures(rows: DataFrame, words: int) -> DataFrame:
    """(uid, equal, n, print, odd) for each of (uid, t); ``equal`` names the set itself, n is its size, odd its parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            equal, sizes, prints, odd = [], [], [], []
            for t in b.column(1):
                found = shingles(t.as_py(), words)
                equal.append(xxhash.xxh3_128_digest(found.tobytes()))
                sizes.append(len(found))
                prints.append(signature(found))
                odd.append(parities(found))
            columns = [pa.array(equal, pa.binary()), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(odd, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["uid", "equal", "n", "print", "odd"])

    return in_arrow(rows, run, "uid long, equal binary, n long, print binary, odd binary")


def tables_for(rows: int, bucket_rows: int = 8192, differ: float = SIXTH) -> tuple[int, int]:
    """Bits of a key and number of tables for so many rows; fewer than 64 rows are no bucket of their own for the sake of more tasks."""
    wanted, spread = (math.ceil(math.log2(max(1, rows) / of)) for of in (bucket_rows, PIVOT_ROWS))
    bits = min(MOST_KEY_BITS, max(0, wanted, min(SPREAD_BITS, spread)))
    met = (1 - differ) ** bits
    return bits, 1 if met == 1 else math.ceil(math.log(MISS) / math.log1p(-met))


def dealt(rows: DataFrame, bits: int, tables: range) -> DataFrame:
    """(key, uid, c, n, fp, fp1, fp2, odd) for each of (uid, c, n, print, odd) and each of ``tables``; fp to fp2 are the first
    192 bits.  Rows without parities get empty ones, which drop no pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picked, powers = _PICKED[tables.start : tables.stop, :bits], 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            prints = np.frombuffer(b"".join(b.column("print").to_pylist()), np.uint8).reshape(-1, BITS // 8)
            keys = np.unpackbits(prints, axis=1)[:, picked] @ powers + (np.arange(tables.start, tables.stop) << MOST_KEY_BITS)
            first = np.ascontiguousarray(prints[:, :24]).view(">i8").astype(np.int64)
            columns = [b.column("uid"), b.column("c"), b.column("n"), *map(pa.array, first.T), b.column("odd")]
            again = pa.array(np.repeat(np.arange(b.num_rows), len(tables)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *(x.take(again) for x in columns)], ["key", "uid", "c", "n", "fp", "fp1", "fp2", "odd"])

    marked = rows if "odd" in rows.columns else rows.withColumn("odd", F.lit(bytes(ODD // 8)))
    return in_arrow(marked, run, "key long, uid long, c long, n long, fp long, fp1 long, fp2 long, odd binary")


def _apart(fp: np.ndarray, c: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions x < y of codes within ``radius``, rows being sorted by their components c, whose own pairs are left out."""
    ends, at = np.searchsorted(c, c, "right"), 0
    while (first := int(ends[at])) < len(fp):
        end = min(at + max(1, CELLS // (len(fp) - first)), len(fp))
        hit = np.flatnonzero(np.bitwise_count(fp[at:end, None] ^ fp[None, first:]) <= radius)
        x, y = np.divmod(hit, len(fp) - first)
        x, y = x + at, y + first
        keep = c[x] < c[y]
        yield x[keep], y[keep]
        if end == len(fp):
            break
        at = end


def candidates(rows: DataFrame, parts: int, radius: int, least: float, pivot: bool) -> DataFrame:
    """(a, b, ca, cb): pairs of :func:`dealt` rows that share a bucket and may be alike by ``least``, their components
    being different; with ``pivot`` only the nearest of another cluster for each row.  A row with
    a null b says that a is in a bucket of too many such pairs."""
    names = ["a", "b", "ca", "cb"]
    others = (1 - least) / (1 + least)  # of two sets' sizes, what at most is in one of them alone

    def search(uid: np.ndarray, c: np.ndarray, n: np.ndarray, odd: np.ndarray, prints: list[np.ndarray], key: np.ndarray) -> Iterator[pa.RecordBatch]:
        def like(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Those of the pairs that may be alike, and what at least is in one of the two alone, of a thousand."""
            for far, words in ((FAR, prints), (None, odd.T)):
                keep = (np.minimum(n[x], n[y]) >= least * np.maximum(n[x], n[y])) & (c[x] != c[y]) if far else slice(None)
                x, y = x[keep], y[keep]
                differ = np.zeros(len(x), np.int64)
                for w in words:
                    differ += np.bitwise_count(w[x] ^ w[y])
                keep = differ <= (far if far else others * (n[x] + n[y]) + 1e-6)
                x, y, differ = x[keep], y[keep], differ[keep]
            return x, y, 1000 * differ // np.maximum(1, n[x] + n[y])

        def pairs(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
            first = uid[x] < uid[y]
            a, b = np.where(first, x, y), np.where(first, y, x)
            return pa.RecordBatch.from_arrays([pa.array(v) for v in (uid[a], uid[b], c[a], c[b])], names)

        if pivot:
            _, roots, sizes = np.unique(key, return_inverse=True, return_counts=True)
            labels = np.unique(c, return_index=True, return_inverse=True)
            labels = labels[1][labels[2]]  # the smallest position of each component
            for x, y in HierarchicalIndex(prints[0], roots).near(NEAR, labels, max(16, PAIRS // int(sizes.max()))):
                x, y, differ = like(x, y)
                order = np.lexsort((differ, x))
                best = order[np.flatnonzero(np.diff(x[order], prepend=-1))]
                merge_labels(labels, x[best], y[best])
                if len(best):
                    yield pairs(x[best], y[best])
            return
        met = 0
        for x, y in _apart(prints[0], c, radius):
            x, y, _ = like(x, y)
            met += len(x)
            if met > DENSE * len(uid):
                none = pa.nulls(len(uid), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(uid), none, pa.array(c), none], names)
                return
            if len(x):
                yield pairs(x, y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        odd = np.concatenate([np.frombuffer(b"".join(b.column("odd").to_pylist()), np.uint64) for b in found]).reshape(-1, ODD // 64)
        key, uid, c, n, *prints = (x.to_numpy() for x in pa.Table.from_batches(found).drop_columns("odd").columns)
        del found
        prints = [p.view(np.uint64) for p in prints]
        order = np.lexsort((gray_rank(prints[0]) if pivot else c, key))
        key, uid, c, n, odd, *prints = (x[order] for x in (key, uid, c, n, odd, *prints))
        ends, at = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)), 0
        while at < len(key):  # a bucket; with pivots an index of whole buckets: as many as INDEX_ROWS hold, or one
            first, last = np.searchsorted(ends, (at, at + INDEX_ROWS), "right")
            end = int(ends[max(first, last - 1) if pivot else first])
            yield from search(*(x[at:end] for x in (uid, c, n, odd)), [p[at:end] for p in prints], key[at:end])
            at = end

    return in_arrow(rows.repartition(parts, "key"), run, "a long, b long, ca long, cb long")


def sets_of(rows: DataFrame, words: int) -> DataFrame:
    """(uid, s): the set of each of (uid, t), as its sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t.as_py(), words).tobytes() for t in b.column(1)], pa.binary())], ["uid", "s"])

    return in_arrow(rows, run, "uid long, s binary")


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those (a, b, ca, cb) whose sets are alike by ``least`` or more, as a forest (ca, cb) of each batch's links."""
    right = pairs.join(sets.select(F.col("uid").alias("b"), F.col("s").alias("sb")), "b")
    both = right.join(sets.select(apart(F.col("uid")).alias("a"), F.col("s").alias("sa")), "a").select("ca", "cb", "sa", "sb")
    read = lambda cell: np.frombuffer(cell.as_buffer(), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.array([jaccard(read(x), read(y)) >= least for x, y in zip(batch.column(2), batch.column(3), strict=True)], bool)
            links = joined(*(batch.column(k).to_numpy()[keep] for k in range(2)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in links], ["ca", "cb"])

    return in_arrow(both, run, "ca long, cb long")


def _moved(rows: DataFrame, moved: DataFrame) -> DataFrame:
    """``rows`` with their components c merged as (id, component) says."""
    named = rows.join(moved.select(apart(F.col("id")).alias("c"), "component"), "c", "left")
    return named.withColumn("c", F.coalesce("component", "c")).select(*rows.columns)


def _open(rows: DataFrame) -> DataFrame:
    """Rows of the buckets that hold more than one component, with the bucket's size as ``many``."""
    several = rows.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("up"), F.count(F.lit(1)).alias("many")).where(F.col("low") < F.col("up"))
    return rows.select("key", "uid", "fp", "c", "n").join(several.select(apart(F.col("key")).alias("key"), "many"), "key")


def _by_rare_shingles(rows: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(key, uid, fp, c, n): the members of ``rows`` by their rarest shingles.

    Of two sets of size n and alike by ``least``, at most n - least * n shingles of the one are missing
    in the other, so they share one of its n - least * n + 1 rarest: no pair is lost.  What many rows have
    in common, a passage or a template, is not rare and brings no pair by itself.
    """
    members = rows.select("uid", "fp", "c", "n").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.frombuffer(cell.as_buffer(), np.int64) for cell in b.column(1)]
            for at in range(0, len(found), 64):
                part = found[at : at + 64]
                uid = np.repeat(b.column(0).to_numpy()[at : at + 64], [len(x) for x in part])
                yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(np.concatenate(part))], ["uid", "key"])

    dealt = in_arrow(sets.join(members.select("uid"), "uid", "left_semi"), run, "uid long, key long")
    many = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    shared = dealt.join(many.select(apart(F.col("key")).alias("key"), "many"), "key")
    lists = shared.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("many", "key"))).alias("s"))  # at most the row's own shingles
    n = F.col("n")
    wanted = F.floor(n * (1 - least) + 1e-6).cast("int") + 1 - (n.cast("int") - F.size("s"))  # those that occur once are the rarest
    kept = members.join(lists, "uid").where(wanted > 0).select("uid", "fp", "c", "n", F.slice("s", F.lit(1), F.greatest(wanted, F.lit(0))).alias("s"))
    return _open(stored(kept.select(F.explode("s.key").alias("key"), "uid", "fp", "c", "n"), "rare-shingles"))


def _all_pairs(rows: DataFrame, radius: int, least: float) -> DataFrame:
    names = ["a", "b", "ca", "cb"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        key, uid, fp, c, n = (x.to_numpy() for x in pa.Table.from_batches(found).columns)
        _, roots, sizes = np.unique(key, return_inverse=True, return_counts=True)
        codes = fp.view(np.uint64)
        order = np.lexsort((gray_rank(codes), roots))
        index, labels = HierarchicalIndex(codes[order], roots[order]), np.unique(c[order], return_inverse=True)[1]
        uid, c, n = uid[order], c[order], n[order]
        for x, y in index.near(radius, labels, block=max(16, PAIRS // int(sizes.max()))):
            like = (x < y) & (np.minimum(n[x], n[y]) >= least * np.maximum(n[x], n[y]))
            x, y = x[like], y[like]
            if len(x):
                first = uid[x] < uid[y]
                a, b = np.where(first, x, y), np.where(first, y, x)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (uid[a], uid[b], c[a], c[b])], names)

    dealt = rows.select("key", "uid", "fp", "c", "n").repartition("key")
    return in_arrow(dealt, run, "a long, b long, ca long, cb long").distinct()


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many items each two sets have in common; exact, with dense blocks of WIDE columns at a time."""
    sizes = [len(s) for s in sets]
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, shared = np.repeat(np.arange(len(sets)), sizes), seen[column] > 1
    renamed = np.cumsum(seen > 1) - 1
    row, column = row[shared], renamed[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)  # counts far below 2^24
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, WIDE):
        first, last = np.searchsorted(column, (at, at + WIDE))
        block = np.zeros((len(sets), min(WIDE, int(column[-1]) + 1 - at)), np.float32)
        block[row[first:last], column[first:last] - at] = 1
        out += block @ block.T
    return out


def _group_links(rows: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(ca, cb) of the links within large buckets, found where their members meet: no pair becomes a row.

    A bucket is cut into blocks of about BLOCK rows, and each two blocks are one group, so that what a
    task holds is bounded whatever the bucket's size.
    """
    cut = F.ceil(F.col("many") / BLOCK).cast("int")
    own = rows.join(sets.withColumn("uid", apart(F.col("uid"))), "uid").select("key", "c", "s", cut.alias("cuts"), F.pmod(F.xxhash64("uid"), cut).cast("int").alias("i"))
    dealt = own.select("key", "c", "s", "i", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("j")).select("key", F.least("i", "j").alias("low"), F.greatest("i", "j").alias("up"), "c", "s")

    def settle(group: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        c, found = np.array([g[0] for g in group]), [g[1] for g in group]
        if len(np.unique(c)) < 2:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["ca", "cb"])
        both, n = _overlaps(found).astype(np.float64), np.array([len(s) for s in found], np.float64)
        x, y = np.nonzero((both / (n[:, None] + n[None, :] - both) >= least) & (c[:, None] < c[None, :]))
        pairs = np.unique(np.stack([c[x], c[y]], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["ca", "cb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []
        for b in batches:
            marks = list(zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
            for mark, c, cell in zip(marks, b.column(3).to_pylist(), b.column(4), strict=True):
                if mark != now:
                    if group:
                        yield settle(group)
                    now, group = mark, []
                group.append((c, np.frombuffer(cell.as_buffer().to_pybytes(), np.uint64)))
        if group:
            yield settle(group)

    met = dealt.repartition("key", "low", "up").sortWithinPartitions("key", "low", "up")
    return in_arrow(met, run, "ca long, cb long").distinct()


def near_copies(rows: DataFrame, *, key_col: str, text_col: str = "text", words: int = 5, least: float = 0.8, radius: int = 26, pivots: int = 1, bucket_rows: int = 8192) -> DataFrame:
    """(key, component) for each row; component is the smallest key reachable."""
    if least < 0.8:
        raise ValueError("tables and radius hold 0.8 and more")
    spark = rows.sparkSession
    texts = rows.select(F.col(key_col).alias("uid"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))

    def kept(df: DataFrame, name: str) -> DataFrame:
        return stored(df, name, shared_path(spark, name))

    with dropped_after(spark):
        signed = stored(signatures(texts, words), "signatures")
        classes = kept(signed.groupBy("equal").agg(F.min("uid").alias("uid")).withColumn("c", F.col("uid")), "equal-sets")
        single = kept(signed.join(classes.select("uid"), "uid", "left_semi").select("uid", "n", "print", "odd"), "distinct-sets")
        named = kept(signed.select("uid", "equal"), "names-of-sets")
    many = classes.count()
    bits, tables = tables_for(many, bucket_rows)
    pivot_bits = tables_for(many, min(bucket_rows, PIVOT_ROWS))[0]

    def sets(of: DataFrame) -> DataFrame:
        keys = stored(of.distinct(), "candidates-keys")
        return stored(sets_of(texts.join(F.broadcast(keys) if keys.count() <= FEW else keys, "uid", "left_semi"), words), "candidates-sets")

    def found(of: DataFrame, tables: range, pivot: bool) -> list[DataFrame]:
        now, out = of.join(classes.select(apart(F.col("uid")).alias("uid"), "c"), "uid").select("uid", "c", "n", "print", "odd"), []
        for at in range(tables.start, tables.stop, SLICE):
            part = range(at, min(at + SLICE, tables.stop))
            parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-many * len(part) // TASK_ROWS))
            out.append(stored(candidates(dealt(now, pivot_bits if pivot else bits, part), parts, radius, least, pivot), "candidates"))
        return out

    for turn in range(pivots + 1):
        with dropped_after(spark):  # what a turn has written but its classes
            if turn == pivots:
                more = tables_for(many, bucket_rows, SHORT_SIXTH)[1]
                parts = found(single, range(tables), False) + found(single.where(F.col("n") <= SHORT), range(tables, more), False)
            else:  # other tables in each turn
                parts = found(single, range(turn * PIVOT_TABLES, (turn + 1) * PIVOT_TABLES if pivot_bits else turn * PIVOT_TABLES + 1), True)
            met = reduce(DataFrame.unionByName, parts)
            pairs = stored(met.where("b IS NOT NULL").distinct(), "pairs")
            crowd = stored(met.where("b IS NULL").select(F.col("a").alias("uid"), F.col("ca").alias("c")).distinct(), "crowds")
            own = sets(pairs.select(F.explode(F.array("a", "b")).alias("uid")).unionByName(crowd.select("uid")))
            links = verified(pairs, own, least)
            if not crowd.isEmpty():
                of = crowd.join(single, "uid").select("uid", F.conv(F.hex(F.substring("print", 1, 8)), 16, -10).cast("long").alias("fp"), "c", "n")
                rare = stored(_by_rare_shingles(of, own, least), "rare-buckets")
                small, large = rare.where(F.col("many") <= SMALL), rare.where(F.col("many") > SMALL)
                links = links.unionByName(verified(_all_pairs(small, radius, least), own, least)).unionByName(_group_links(large, own, least))
            moved = components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
            if moved is not None:
                classes = kept(_moved(classes, moved), "classes")
    of_sets = classes.select(F.concat("equal", F.lit(b"")).alias("equal"), "c")  # a key whose partitioning Spark doesn't know
    return named.join(of_sets, "equal").select(F.col("uid").alias(key_col), F.col("c").alias("component"))
