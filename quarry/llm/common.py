"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import drop_path, dropped_after, in_arrow, shared_path, shared_root, ship, stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def apart(column: Column) -> Column:
    """A long key whose partitioning Spark doesn't know.

    What was aggregated by a key is already dealt out by it, so a join on the key adds no
    exchange on that side, and adaptive execution splits hot keys only between two exchanges of
    a join's own.  With this key it gets them.
    """
    return F.bitwise_not(F.bitwise_not(column))


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased and nothing else, unlike ``lower``, which follows Unicode."""
    return F.translate(column, UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


__all__ = ["apart", "ascii_lower", "drop_path", "dropped_after", "in_arrow", "shared_path", "shared_root", "stored", "table"]
