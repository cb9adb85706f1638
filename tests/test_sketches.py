import pytest
from pyspark.sql import functions as F

from quarry.operators import profile, sketches


@pytest.fixture(scope="module")
def rows(spark):
    """A key of 60,000 values, a column of which one value has a third of the rows, a number with nulls, and a list."""
    i = F.col("id")
    return spark.range(60_000).select(
        F.concat(F.lit("key-"), i.cast("string")).alias("key"),
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), (i % 20_011).cast("string"))).alias("skewed"),
        F.when(i % 5 > 0, i.cast("double")).alias("x"),
        F.array(F.struct((i % 7).alias("k"))).alias("l"),
        F.lit(None).cast("string").alias("nothing"),
    ).repartition(6)


def test_bounds_on_a_key_column_and_a_hot_value(rows):
    got = {r.path: r for r in sketches.stats(sketches.sketched(rows)).collect()}
    exact = {r.path: r for r in profile.field_stats(rows).collect()}
    assert set(got) == set(exact) and {p: r.filled for p, r in got.items()} == {p: r.filled for p, r in exact.items()}
    for path in ("key", "skewed", "x"):
        assert got[path].distinct == pytest.approx(exact[path].distinct, rel=0.05)
    assert got["l[0].k"].distinct == 7 and got["nothing"].distinct == 0 and got["nothing"].numbers is None
    assert got["x"].numbers[0] == 1.0 and got["x"].numbers[-1] == 59_999.0
    assert got["x"].numbers[2] == pytest.approx(30_000, abs=0.02 * 60_000)
    assert got["key"].lengths[0] == 5 and got["key"].lengths[-1] == 9


def test_frequent_values_are_exact(rows):
    hot = {(r.path, r.value): r.n for r in sketches.frequent(rows, 0.1).collect()}
    assert hot == {("skewed", "hot"): 20_000} | {("l[0].k", str(k)): sum(1 for i in range(60_000) if i % 7 == k) for k in range(7)}
    want = {(r.path, r.value): r.n for r in profile.field_values(rows).where("value <> '<NULL>'").collect() if r.n >= 0.002 * 60_000}
    assert {(r.path, r.value): r.n for r in sketches.frequent(rows, 0.002).collect()} == want
    with pytest.raises(ValueError):
        sketches.frequent(rows, 0.0001)


def test_merged_sketches_are_those_of_the_whole(rows):
    parts = [sketches.sketched(rows.where(F.pmod(F.xxhash64("key"), F.lit(4)) == k)) for k in range(4)]
    whole, got = ({r.path: r for r in sketches.stats(p).collect()} for p in (sketches.sketched(rows), sketches.merged(*parts)))
    assert {p: (r.rows, r.filled) for p, r in got.items()} == {p: (r.rows, r.filled) for p, r in whole.items()}
    assert got["key"].distinct == pytest.approx(60_000, rel=0.05)
    assert {(r.path, r.value) for r in sketches.frequent(rows, 0.1, sketches.merged(*parts)).collect()} == {(r.path, r.value) for r in sketches.frequent(rows, 0.1).collect()}


def test_the_shuffle_does_not_depend_on_the_values(spark, rows):
    """Before the exchange there is one row for each path and task."""
    plan = sketches.sketched(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(path") == 1 and "hashpartitioning(path#" in plan and ", value#" not in plan.split("Exchange hashpartitioning(")[1].split("\n")[0]


def test_empty_table(rows):
    assert sketches.stats(sketches.sketched(rows.limit(0))).collect() == [] and sketches.frequent(rows.limit(0)).collect() == []
