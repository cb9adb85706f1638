"""Kendall's tau-b by counting inversions: n log n for a list of n, and for lists too long for one task.

Of n (n - 1) / 2 pairs, some are tied in x, some in y, some in both; the discordant ones are the inversions of y where the list is in the order of
x, and what is left is concordant.  Inversions of all lists in a task are counted together, bit by bit of y's ranks.

A list of more than ``block`` rows is cut into blocks of x and into blocks of y, at quantiles that Spark's sketches find, so a value is never cut apart.  A discordant pair
is in one block of x, or in two; then in one block of y, or in two.  The first are counted block by block of x; the second block by block of y, less those
that are in one block of x, too; the third follow from how many rows each pair of blocks has, a table of blocks squared.  A block of a single
value holds no discordant pair and isn't gathered, so a value that a third of the rows has costs nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import in_arrow, stored

BLOCK, MOST_CUTS, HELD = 100_000, 10_000, 500_000


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks of rows by several keys, the first one first."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def discordant(group: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each group number, how many pairs have x in one order and y in the other, neither being equal."""
    out = np.zeros(int(group.max()) + 1 if len(group) else 0, np.int64)
    order = np.lexsort((y, x, group))
    owner, rank = group[order], _ranks(group[order], y[order])  # no inversion between groups, or between equal x
    bits = int(rank.max()).bit_length() if len(rank) else 0
    for b in range(bits - 1, -1, -1):
        # Rows are in runs of equal higher bits, each in the order of x: a 0 after a 1 is an inversion.
        high, one = rank >> (b + 1), rank >> b & 1
        start = np.flatnonzero(np.concatenate(([True], high[1:] != high[:-1])))
        run = np.repeat(start, np.diff(np.append(start, len(rank))))
        ones = np.cumsum(one) - one
        before = ones - ones[run]
        np.add.at(out, owner[one == 0], before[one == 0])
        zeros = np.add.reduceat(1 - one, start)
        place = np.where(one == 0, run + (np.arange(len(rank)) - run - before), run + np.repeat(zeros, np.diff(np.append(start, len(rank)))) + before)
        moved = np.empty(len(rank), np.int64)
        moved[place] = np.arange(len(rank))
        rank, owner = rank[moved], owner[moved]
    return out


def _tied(group: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For each group number, how many pairs are equal in all keys."""
    rank = _ranks(group, *keys)
    many = np.bincount(rank)
    out = np.zeros(int(group.max()) + 1, np.int64)
    first = np.zeros(len(many), np.int64)
    first[rank] = group
    np.add.at(out, first, many * (many - 1) // 2)
    return out


def tau(pairs: Column, in_x: Column, in_y: Column, in_both: Column, wrong: Column) -> Column:
    """tau-b from numbers of pairs: all, tied in x, in y and in both, discordant."""
    right = pairs - in_x - in_y + in_both - wrong
    return F.try_divide((right - wrong).cast("double"), F.sqrt((pairs - in_x).cast("double") * (pairs - in_y).cast("double")))


COUNTS = ["pairs", "in_x", "in_y", "in_both", "wrong"]


def _in_tasks(rows: DataFrame, by: list[str], what: str) -> DataFrame:
    """``what`` (COUNTS, or the discordant pairs alone) of each of the ``by``, which are dealt out and sorted, so that a task holds about HELD rows at a time."""
    names = COUNTS if what == "all" else ["wrong"]
    dealt = rows.select(*by, F.xxhash64(*by).alias("_h"), "x", "y").repartition(*by).sortWithinPartitions("_h", *by)
    at = len(by)

    def settled(t: pa.Table) -> pa.RecordBatch:
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for k in range(at):
            column = t.column(k).combine_chunks()
            codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        group, x, y = np.cumsum(new) - 1, t.column(at + 1).to_numpy(), t.column(at + 2).to_numpy()
        n = np.bincount(group)
        found = [discordant(group, x, y)] if what != "all" else [n * (n - 1) // 2, _tied(group, x), _tied(group, y), _tied(group, x, y), discordant(group, x, y)]
        head = t.select(range(at)).take(pa.array(np.flatnonzero(new))).combine_chunks()
        return pa.RecordBatch.from_arrays([*(head.column(k).combine_chunks() for k in range(at)), *map(pa.array, found)], [*by, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size >= HELD:
                t = pa.Table.from_batches(held)
                mark = t.column(at).to_numpy()
                cut = int(np.flatnonzero(mark != mark[-1])[-1]) + 1 if (mark != mark[-1]).any() else 0  # the last group may go on
                if cut:
                    yield settled(t.slice(0, cut))
                held, size = t.slice(cut).to_batches(), t.num_rows - cut
        if size:
            yield settled(pa.Table.from_batches(held))

    return in_arrow(dealt, run, rows.select(*by, *[F.lit(0).cast("long").alias(n) for n in names]).schema)


def _several(rows: DataFrame, by: list[str], block: int) -> DataFrame:
    """COUNTS of lists that don't fit in a task."""
    choose = lambda n: n * (n - 1) / 2
    whole = F.lit(0).cast("decimal(38,0)")
    longest = rows.groupBy(*by).count().agg(F.max("count")).head()[0]
    cuts = min(MOST_CUTS, -(-longest // block))
    shares = F.array(*[F.lit(k / cuts) for k in range(1, cuts)])
    edges = rows.groupBy(*by).agg(F.percentile_approx("x", shares, 10 * cuts).alias("cx"), F.percentile_approx("y", shares, 10 * cuts).alias("cy"))
    same = [F.col(c).eqNullSafe(F.col(f"_e_{c}")) for c in by]
    cut = rows.join(edges.withColumnsRenamed({c: f"_e_{c}" for c in by}), same)
    place = lambda v, c: F.size(F.filter(c, lambda e: e < F.col(v)))
    # Written once: sketches of another run could cut elsewhere.
    cut = stored(cut.select(*by, "x", "y", place("x", "cx").alias("bx"), place("y", "cy").alias("by")), "blocks")
    # Ties, from counts of equal rows.
    equal = cut.groupBy(*by, "x", "y").agg(F.count(F.lit(1)).alias("n"))
    pairs = lambda df, name: df.groupBy(*by).agg(F.sum(choose(F.col("n")).cast("decimal(38,0)")).alias(name))
    in_both = pairs(equal, "in_both")
    in_x, in_y = (pairs(equal.groupBy(*by, c).agg(F.sum("n").alias("n")), f"in_{c}") for c in ("x", "y"))
    all_ = pairs(equal.groupBy(*by).agg(F.sum("n").alias("n")), "pairs")

    def within(keys: list[str]) -> DataFrame:
        """Discordant pairs within blocks; those of one value have none."""
        spread = cut.groupBy(*by, *keys).agg(((F.min("x") < F.max("x")) & (F.min("y") < F.max("y"))).alias("_open")).where("_open").drop("_open")
        named = spread.withColumnsRenamed({c: f"_k_{c}" for c in [*by, *keys]})
        open_ = cut.join(named, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*by, *keys]], "left_semi")
        return _in_tasks(open_, [*by, *keys], "wrong").groupBy(*by).agg(F.sum(F.col("wrong").cast("decimal(38,0)")).alias("wrong"))

    # Rows in blocks left of one in x and above it in y: sums over a table of blocks.
    cells = cut.groupBy(*by, "bx", "by").agg(F.count(F.lit(1)).alias("n"))
    ys = F.collect_list(F.struct("by", "n"))
    columns = cells.groupBy(*by, "bx").agg(F.map_from_entries(ys).alias("m"))  # at most MOST_CUTS entries
    seen = F.collect_list("m").over(Window.partitionBy(*by).orderBy("bx").rowsBetween(Window.unboundedPreceding, -1)) if cuts <= 100 else None
    if seen is not None:
        above = lambda k: F.aggregate(F.col("before"), whole, lambda s, m: s + F.aggregate(F.map_entries(m), whole, lambda t, e: F.when(e["key"] > k, (t + e["value"]).cast("decimal(38,0)")).otherwise(t)).cast("decimal(38,0)"), lambda s: s)
        cross = columns.withColumn("before", seen)
        cross = cross.select(*by, F.explode(F.map_entries("m")).alias("e"), "before").select(*by, (above(F.col("e.key")) * F.col("e.value")).cast("decimal(38,0)").alias("w"))
    else:
        left = cells.withColumnsRenamed({**{c: f"_l_{c}" for c in by}, "bx": "lx", "by": "ly", "n": "ln"})
        cross = cells.join(left, [F.col(c).eqNullSafe(F.col(f"_l_{c}")) for c in by] + [F.col("lx") < F.col("bx"), F.col("ly") > F.col("by")]).select(*by, (F.col("n").cast("decimal(38,0)") * F.col("ln")).cast("decimal(38,0)").alias("w"))
    cross = cross.groupBy(*by).agg(F.sum("w").alias("wrong"))
    signed = within(["bx"]).unionByName(within(["by"])).unionByName(within(["bx", "by"]).withColumn("wrong", -F.col("wrong"))).unionByName(cross)
    wrong = signed.groupBy(*by).agg(F.sum("wrong").alias("wrong"))
    out = all_
    for k, more in enumerate((in_x, in_y, in_both, wrong)):
        named = more.withColumnsRenamed({c: f"_j{k}_{c}" for c in by})
        out = out.join(named, [F.col(c).eqNullSafe(F.col(f"_j{k}_{c}")) for c in by], "left").drop(*[f"_j{k}_{c}" for c in by])
    return out.select(*by, *[F.coalesce(F.col(c), whole).alias(c) for c in COUNTS])


def kendall(df: DataFrame, by: list[str], x: str, y: str, *, block: int = BLOCK) -> DataFrame:
    """(by, kendall): tau-b of each list; null where all of x or all of y are equal, or one is null."""
    rows = df.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("x").isNull() | F.col("y").isNull(), 1)).alias("_nulls"))
    whole = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    long = sizes.where(F.col("_n") > block)
    result = tau(*map(F.col, COUNTS)).alias("kendall")
    if long.isEmpty():
        found = _in_tasks(whole, by, "all").select(*by, result)
    else:
        named = F.broadcast(long.select(*[F.col(c).alias(f"_s_{c}") for c in by]))  # lists of over ``block`` rows: few
        same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in by]
        short = _in_tasks(whole.join(named, same, "left_anti"), by, "all").select(*by, result)
        found = short.unionByName(_several(whole.join(named, same, "left_semi"), by, block).select(*by, result))
    named = found.withColumnsRenamed({c: f"_f_{c}" for c in by})
    joined = sizes.join(named, [F.col(c).eqNullSafe(F.col(f"_f_{c}")) for c in by], "left")
    return joined.select(*by, F.when(F.col("_nulls") == 0, F.col("kendall")).alias("kendall"))
