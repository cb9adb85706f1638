"""Splitting tables into parts, by row number or by a field's value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.paths import nested_get, text_of
from quarry.functions.text import file_name
from quarry.session import stored


#: Bytes of a table, as Spark estimates them, that one range holds; rows of a broadcast of totals.
RANGE_BYTES, MOST_TOTALS = 128 << 20, 100_000
UNKNOWN = 1 << 60  # what Spark says of a size that it doesn't know
_LOW = (1 << 33) - 1  # the bits of a row's place in its partition, in Spark's increasing ids


def ranges(df: DataFrame) -> int:
    """How many ranges a table is cut into: by the size of what it is read from, and no fewer than there are cores to work on them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    size = sum(s for s in sizes if s < UNKNOWN)
    return max(df.sparkSession.sparkContext.defaultParallelism, min(100_000, -(-size // RANGE_BYTES)))


def _at_most(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def row_numbers(df: DataFrame, *order: str, by: list[str] = (), groups: int | None = None) -> DataFrame:
    """``df`` with ``n`` (from 0) in the order of a unique key, within ``by`` if given.

    Without a single sort in one task: rows are dealt into as many ranges of the key as the table's size asks for (``groups`` sets another
    number), sorted within them and written once.  A row's place in its range is then known, and what comes before a range is the sum of
    the counts before it, a table with a row for each range; within ``by`` the first number of each value is taken off.
    """
    key = [F.col(c) for c in (*by, *order)]
    dealt = df.repartitionByRange(groups or ranges(df), *key).sortWithinPartitions(*key)
    placed = stored(dealt.select(*df.columns, F.monotonically_increasing_id().alias("_m")), "row-numbers")
    placed = placed.withColumn("_g", F.shiftright("_m", 33))
    counts = placed.groupBy("_g").agg(F.count(F.lit(1)).alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_g", before.alias("_o"))  # a row for each range, 100,000 at most
    numbered = placed.join(F.broadcast(offsets), "_g").withColumn("n", F.col("_o") + F.col("_m").bitwiseAND(F.lit(_LOW)))
    if by:
        first = numbered.groupBy(*by).agg(F.min("n").alias("_first")).withColumnsRenamed({c: f"_by_{c}" for c in by})
        same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
        numbered = numbered.join(F.broadcast(first) if _at_most(first, MOST_TOTALS) else first, same).withColumn("n", F.col("n") - F.col("_first"))
    return numbered.select(*df.columns, F.col("n").cast("long").alias("n"))


def suffix(part: Column) -> Column:
    """A to Z for parts 0 to 25, then the number."""
    return F.when(part < 26, F.char(part + 65)).otherwise((part + 1).cast("string"))


def even_parts(df: DataFrame, parts: int, *order: str, by: list[str] = ()) -> DataFrame:
    """``df`` with ``part`` (from 0) of ``parts`` contiguous parts; the first ones take the rest."""
    numbered = row_numbers(df, *order, by=by)
    if by:
        sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_t")).withColumnsRenamed({c: f"_of_{c}" for c in by})
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
        joined = numbered.join(F.broadcast(sizes) if _at_most(sizes, MOST_TOTALS) else sizes, same)
    else:
        joined = numbered.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("_t"))))  # one row
    size, rest = F.floor(F.col("_t") / parts), F.col("_t") % parts
    edge = rest * (size + 1)
    part = F.when(F.col("n") < edge, F.floor(F.col("n") / (size + 1))).otherwise(rest + F.floor((F.col("n") - edge) / F.greatest(size, F.lit(1))))
    return joined.withColumn("part", part.cast("int")).select(*df.columns, "part")


def by_field(df: DataFrame, path: str) -> DataFrame:
    """``df`` with ``part_name``: the file name of the row's value at ``path``.

    Values whose names fall together get _1, _2, ... in the order of the values.
    """
    value = text_of(nested_get(df, path))
    marked = df.withColumn("_v", value)
    names = marked.select("_v").distinct().withColumn("_n", file_name(F.col("_v")))
    place = F.row_number().over(Window.partitionBy("_n").orderBy("_v")) - 1
    names = names.withColumn("_p", place).withColumn("part_name", F.when(F.col("_p") == 0, F.col("_n")).otherwise(F.concat_ws("_", "_n", F.col("_p").cast("string")))).select("_v", "part_name")
    return marked.join(names, "_v").drop("_v")
