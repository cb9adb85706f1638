import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import split
from quarry.sources import arrow_tables as a


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_parts_schema_and_lineage_read_back(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.range(100).select("id", F.when(F.col("id") % 3 == 0, "a/b").when(F.col("id") % 3 == 1, None).otherwise("ü x").alias("v"), F.array(F.struct(F.col("id").alias("k"))).alias("l")).repartition(4)
    named = split.by_field(df, "v")
    a.save_arrow(named, path, {"step": "split"}, part="part_name")
    assert a.read_arrow(spark, path).schema.simpleString() == df.schema.simpleString()
    assert rows(a.read_arrow(spark, path)) == rows(df)
    names = {r.part_name: r["count"] for r in named.groupBy("part_name").count().collect()}
    assert a.parts(path) == dict(sorted(names.items())) and len(names) == 3
    for name in names:
        assert rows(a.read_arrow(spark, path, name)) == rows(named.where(F.col("part_name") == name).drop("part_name"))
    assert a.read_arrow(spark, path, "nobody").count() == 0
    a.save_arrow(a.read_arrow(spark, path).where("id < 10"), f"{path}2", {"step": "cut"}, before=path)
    assert [s["step"] for s in a.lineage(f"{path}2")] == ["split", "cut"] and a.read_arrow(spark, f"{path}2").count() == 10


def test_an_empty_table_keeps_its_schema(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    a.save_arrow(spark.range(0).withColumn("s", F.lit("x")), path, {"step": "none"}, part="s")
    assert a.read_arrow(spark, path).collect() == [] and a.read_arrow(spark, path).columns == ["id"] and a.parts(path) == {}


def test_failed_writes_leave_nothing_readable(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    bad = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") < 3990, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        a.save_arrow(bad, path, {})
    with pytest.raises(Exception, match="no table"):
        a.read_arrow(spark, path).count()
    a.save_arrow(spark.range(5), path, {"step": "good"})
    with pytest.raises(Exception, match="broken"):
        a.save_arrow(bad, path, {})
    assert a.read_arrow(spark, path).count() == 5 and len(a.entries(path)) == 1
    a.swept(path)
    left = [f for _, _, names in os.walk(f"{tmp_path}/t/data") for f in names]
    assert len(left) == len(a.live_files(a.entries(path))) and a.read_arrow(spark, path).count() == 5


def test_a_second_writer_of_a_version_raises(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    schema = spark.range(1).schema
    first, second = (a._Writer({"path": path}, schema, True) for _ in range(2))
    first.commit([first.write(iter([pa.record_batch([pa.array([1, 2])], ["id"])]))])
    with pytest.raises(RuntimeError, match="meanwhile"):
        second.commit([second.write(iter([pa.record_batch([pa.array([3])], ["id"])]))])
    assert rows(a.read_arrow(spark, path)) == [(1,), (2,)]
    with pytest.raises(ValueError, match="schema"):
        a._Writer({"path": path}, spark.range(1).withColumn("x", F.lit(1)).schema, False)


def test_appended_and_replaced(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for k in range(3):
        a.save_arrow(spark.range(k * 10, k * 10 + 10), path, {"k": k}, append=True)
    assert a.read_arrow(spark, path).count() == 30 and [s["k"] for s in a.lineage(path)] == [0, 1, 2]
    a.save_arrow(spark.range(4), path, {"k": 3})
    assert a.read_arrow(spark, path).count() == 4


def drained(spark, path, out, **options):
    seen = []

    def take(batch, k):
        seen.append(batch.count())
        batch.write.mode("append").parquet(f"{out}/rows")

    run = a.follow_arrow(spark, path, **options).writeStream.foreachBatch(take).option("checkpointLocation", f"{out}/checkpoint").start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    return [n for n in seen if n]


def test_a_stream_reads_each_commit_once(spark, tmp_path):
    path, out = f"file://{tmp_path}/t", f"file://{tmp_path}/out"
    for k in range(3):
        a.save_arrow(spark.range(k * 10, k * 10 + 10), path, {}, append=True)
    assert drained(spark, path, out, max_commits=2, consumer="c 1") == [20, 10]
    a.save_arrow(spark.range(30, 41), path, {}, append=True)
    a.save_arrow(spark.range(41, 45), path, {}, append=True)
    assert drained(spark, path, out, max_commits=1, consumer="c 1") == [11, 4]
    assert sorted(r.id for r in spark.read.parquet(f"{out}/rows").collect()) == list(range(45))


def test_small_files_are_read_together():
    assert [len(p.paths) for p in a._packed([("x", 10)] * 100)] == [63, 37]
    assert [len(p.paths) for p in a._packed([("x", 200 << 20)] * 3)] == [1, 1, 1]
