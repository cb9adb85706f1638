"""The row-wise operators on a stream: new conversations as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def follow(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files that appear below ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def annotate(stream: DataFrame, change: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Apply a row-wise operator to all files there are, once each, then stop.

    The checkpoint remembers the files done: a later call takes up where this one ended.
    """
    return change(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
