"""Profiles of fields by mergeable sketches: distinct values, quantiles and frequent values of every path in one pass.

A task sums up what it reads in one row a path, so what is shuffled depends on the paths and not on the values.  Sketches of several
tables, or of a table's days, are merged without reading those again.  Frequent values are then made exact by a second pass that counts the
candidates only, which are few.

Bounds: the number of distinct values is within three times ``1.04 / sqrt(2 ** bits)`` of the truth (2.6 % at 12 bits), with a probability of 99.7 %, and
practically exact up to some hundred values; a quantile's rank is within 1.7 % at a size of 200; a value with a share of the rows above ``4 / tracked`` is
among the candidates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.profile import cells

#: What a null value is as text (see :func:`quarry.functions.paths.text_of`).
NULL = "<NULL>"


def sketched(df: DataFrame, *, bits: int = 12, tracked: int = 4096, size: int = 200) -> DataFrame:
    """(path, type, rows, filled, values, frequent, numbers, lengths): a row for each path, the last four are sketches.

    ``values`` counts distinct values, ``frequent`` holds candidates for frequent ones, ``numbers`` the distribution
    of what is a number, ``lengths`` that of the texts' lengths.  Nulls count as rows only.
    """
    real = F.col("value") != NULL
    value = F.when(real, F.col("value"))
    rows = cells(df).select("path", "type", value.alias("value"))
    return rows.groupBy("path", "type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("filled"),
        F.hll_sketch_agg("value", bits).alias("values"),
        F.expr(f"approx_top_k_accumulate(value, {tracked})").alias("frequent"),
        F.kll_sketch_agg_double(F.col("value").try_cast("double"), size).alias("numbers"),
        F.kll_sketch_agg_bigint(F.length("value").cast("long"), size).alias("lengths"),
    )


def merged(*tables: DataFrame, tracked: int = 4096) -> DataFrame:
    """One profile of several tables' sketches."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    return rows.groupBy("path", "type").agg(
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.hll_union_agg("values").alias("values"),
        F.expr(f"approx_top_k_combine(frequent, {tracked})").alias("frequent"),
        F.kll_merge_agg_double("numbers").alias("numbers"),
        F.kll_merge_agg_bigint("lengths").alias("lengths"),
    )


def stats(profile: DataFrame, *, quantiles: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """(path, type, rows, filled, distinct, numbers, lengths): estimates; the last two are the quantiles, null where there is nothing to rank."""

    def ranks(kind: str, column: str):
        held = F.expr(f"kll_sketch_get_n_{kind}({column})") > 0
        return F.when(held, F.array(*[F.expr(f"kll_sketch_get_quantile_{kind}({column}, {q}D)") for q in quantiles]))

    return profile.select("path", "type", "rows", "filled", F.hll_sketch_estimate("values").alias("distinct"), ranks("double", "numbers").alias("numbers"), ranks("bigint", "lengths").alias("lengths"))


def candidates(profile: DataFrame, share: float) -> DataFrame:
    """(path, value): at most 2 / ``share`` values a path, among them all with at least that share of its filled rows."""
    most = int(2 / share)
    found = profile.where("filled > 0").select("path", F.explode(F.expr(f"approx_top_k_estimate(frequent, {most})")).alias("v"))
    return found.select("path", F.col("v.item").alias("value"))


def frequent(df: DataFrame, share: float = 0.01, profile: DataFrame | None = None, *, tracked: int = 4096) -> DataFrame:
    """(path, type, value, n): the values with at least ``share`` of a path's filled rows, counted exactly.

    The first pass (or ``profile``, an older one of the same rows) names the candidates, a second counts those: the
    candidates, 2 / ``share`` a path, are sent to all tasks, and only their counts are shuffled.
    """
    if not 4 / tracked < share <= 1:
        raise ValueError(f"a share above 4 / tracked = {4 / tracked} can be told from sketches")
    profile = sketched(df, tracked=tracked) if profile is None else profile
    counted = cells(df).where(F.col("value") != NULL).join(F.broadcast(candidates(profile, share)), ["path", "value"]).groupBy("path", "type", "value").agg(F.count(F.lit(1)).alias("n"))
    filled = F.broadcast(profile.select("path", "type", "filled"))  # a row a path
    return counted.join(filled, ["path", "type"]).where(F.col("n") >= share * F.col("filled")).select("path", "type", "value", "n")
