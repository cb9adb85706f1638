"""Reading and writing: lines of JSON, splits, prompts, reports, lineage; Arrow tables are in :mod:`quarry.sources.arrow_tables`."""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import stored
from quarry.sources.arrow_tables import read_arrow  # noqa: F401  beside the other readers


def read_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped, unreadable ones are null rows
    with their text in ``_corrupt`` if the schema has it."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def choose_split(df: DataFrame, split_col: str = "split", wanted: str = "train") -> DataFrame:
    """The wanted split if there is one, else the first by name."""
    first = df.agg(F.min(split_col).alias("lo"), F.max((F.col(split_col) == wanted).cast("int")).alias("has")).head()
    return df.where(F.col(split_col) == (wanted if first.has else first.lo))


PROMPTS = "benchmark string, eval_idx long, prompt string, split_name string"


def gather_prompts(tables: list[tuple[str, DataFrame | Callable[[], DataFrame], list[str], str]], *, skip: bool = False) -> DataFrame:
    """(benchmark, eval_idx, prompt, split_name) from (name, table, columns, split).

    Rows are numbered by their content, so that the numbers don't depend on files.  A table may be a
    function that reads it; with ``skip`` one that can't be read, lacks a column or breaks while it is read is left out and logged: its
    prompts are written to the shared folder first, and read from there.
    """
    out = None
    for name, source, columns, split in tables:
        try:
            df = source() if callable(source) else source
            found = [df.select(F.lit(name).alias("benchmark"), F.xxhash64(c).alias("eval_idx"), F.col(c).cast("string").alias("prompt"), F.lit(split).alias("split_name")).where(F.col("prompt").isNotNull()) for c in columns]
            found = [stored(rows, "prompts") for rows in found] if skip else found
        except (PySparkException, Py4JJavaError) as e:
            if not skip:
                raise
            logging.getLogger(__name__).warning("benchmark %s is left out: %s", name, e)
            continue
        for rows in found:
            out = rows if out is None else out.unionByName(rows)
    return SparkSession.active().createDataFrame([], PROMPTS) if out is None else out


def read_reports(spark: SparkSession, folder: str, ending: str = "__contamination_report.json") -> tuple[DataFrame, list[str]]:
    """(benchmark, id) of the reports in a folder, one JSON object by id each, and the names of those that can't be read.

    A report without contamination has no row.
    """
    files = spark.read.option("wholetext", "true").option("pathGlobFilter", f"*{ending}").text(folder).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    held = files.select(F.replace(F.url_decode("file"), F.lit(ending), F.lit("")).alias("benchmark"), F.try_parse_json("value").alias("v"))
    broken = sorted(r.benchmark for r in held.where(F.col("v").isNull()).select("benchmark").collect())  # names only
    ids = held.where(F.col("v").isNotNull()).select("benchmark", F.explode(F.map_keys(F.from_json(F.to_json("v"), "map<string,string>"))).alias("id"))
    return ids, broken


def cached(spark: SparkSession, folder: str, make: Callable[[], DataFrame], *key: object) -> DataFrame:
    """The table kept under ``key`` in a folder, made and written if there is none that was finished."""
    path = f"{folder.rstrip('/')}/{hashlib.md5('_'.join(map(str, key)).encode()).hexdigest()}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _driver_write(spark: SparkSession, path: str, text: str) -> None:
    """A small file through Hadoop's file system, so any store Spark knows will do."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def _driver_read(spark: SparkSession, path: str) -> str | None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return "\n".join(r.value for r in spark.read.text(path).collect())  # a log of a few lines


def save(df: DataFrame, path: str, step: dict, *, partition_by: list[str] = (), before: str | None = None) -> None:
    """Write a table and, beside it, its lineage: that of ``before`` and this step.

    An empty table is written with its schema.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    old = json.loads(_driver_read(spark, f"{(before or path).rstrip('/')}.lineage.json") or '{"processing_log": []}')
    old["processing_log"].append({**step, "timestamp": datetime.now(timezone.utc).isoformat()})
    _driver_write(spark, f"{path.rstrip('/')}.lineage.json", json.dumps(old, indent=1))


def lineage(spark: SparkSession, path: str) -> list[dict]:
    return json.loads(_driver_read(spark, f"{path.rstrip('/')}.lineage.json") or '{"processing_log": []}')["processing_log"]


def describe(df: DataFrame, split_col: str | None = None) -> DataFrame:
    """(split, rows) of a table."""
    key = F.col(split_col) if split_col else F.lit("train")
    return df.groupBy(key.alias("split")).agg(F.count(F.lit(1)).alias("rows"))
