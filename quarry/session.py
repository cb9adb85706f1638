"""Code for the executors, and folders that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


#: Paths that the innermost open :func:`dropped_after` deletes.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows of an Arrow batch.  Rows here are texts of some kilobytes; 10,000 of them are tens of megabytes, several times over in a worker.
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once for each application.

    Python functions name their modules; workers that don't have the package on
    their path get it from the driver, as with ``--py-files``.  Arrow batches get BATCH_ROWS rows unless the session sets another number.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH) == "10000":  # Spark's default; a session that says otherwise keeps what it says
        spark.conf.set(BATCH, str(BATCH_ROWS))
    if getattr(context, "_quarry_shipped", None) is None:
        here = Path(__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="quarry-code-")) / "quarry.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(here.rglob("*.py")):
                z.write(p, p.relative_to(here.parent))
        context.addPyFile(str(archive))
        context._quarry_shipped = str(archive)
    return spark


def sent_file(spark: SparkSession, path: str) -> str:
    """Send a file of the driver's to the executors, once; ``SparkFiles.get`` of the name returned is its place there."""
    context, name = spark.sparkContext, os.path.basename(path)
    sent = context.__dict__.setdefault("_quarry_files", {})
    if sent.setdefault(name, path) != path:
        raise ValueError(f"another file of the name {name} is in use: {sent[name]}")
    context.addFile(path)
    return name


def in_arrow(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with the package on the executors.

    A Python function takes the files it needs with it when it is made, so the
    package has to be shipped before, whoever made ``df``.
    """
    ship(df.sparkSession)

    def tidy(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()  # workers are kept for later tasks, what they held isn't

    return df.mapInArrow(tidy, schema)


def spread(df: DataFrame, core_bytes: int = 16 << 20) -> DataFrame:
    """``df`` over all cores if it is too small to be so by itself.

    A small file with one row group is one task, however many cores wait.  Tables over
    ``core_bytes`` a core are left as they are read: there a shuffle would cost more.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < core_bytes * cores else df


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the
    context's checkpoint folder.

    Where neither is set, a local master gets a folder of its own, set on the context so
    that checkpoints go there too; a cluster raises, as its executors don't share a disk.
    """
    context = ship(spark).sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="quarry-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root, removed when the application ends."""
    path = f"{shared_root(spark)}/quarry-{uuid.uuid4().hex}-{name}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder written by :func:`stored` that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def dropped_after(spark: SparkSession) -> Iterator[None]:
    """Deletes what :func:`stored` writes within, when it ends, but for tables whose path was given.

    It is for work whose results are written before it ends: what is still lazy then can't be read any more.
    """
    token = _WRITTEN.set(written := [])
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for path in written:
            drop_path(spark, path)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage with a table that outlives any executor, so a lost
    executor costs a re-read and not a recomputation.  Once the table is written nothing reads
    the shuffle files behind it, so Spark is told to delete them with the query.
    """
    spark = df.sparkSession
    if path is None:
        path = shared_path(spark, name)
        if (written := _WRITTEN.get()) is not None:
            written.append(path)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)
