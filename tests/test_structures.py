import json
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import profile, structures


def shape(v):
    if isinstance(v, dict):
        return {k: shape(x) for k, x in v.items()}
    if isinstance(v, list):
        return [shape(x) for x in v[:1]]
    return None if v is None else "bool" if isinstance(v, bool) else "int" if isinstance(v, int) else "float" if isinstance(v, float) else "str"


def value(rng, depth=0):
    kind = rng.random()
    if depth < 5 and kind < 0.4:
        return {k: value(rng, depth + 1) for k in ("a", "items", "metadata", "x.y", "0", "[0]") if rng.random() < 0.4}
    if depth < 5 and kind < 0.6:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 2))]
    return rng.choice([None, None, "s", 1, 1.5, True])


@pytest.mark.parametrize("seed", range(4))
def test_the_merge_is_the_fold_of_the_rule(spark, seed):
    rng = random.Random(seed)
    values = [{"v": value(rng), "w": value(rng)} for _ in range(40)]
    want = profile.fill_unknown(profile.merge_skeletons(*map(shape, values)))
    rows = [(k, json.dumps(v)) for k, v in enumerate(values)] + [(50, "{broken"), (51, None)]
    df = spark.createDataFrame(rows, "k long, t string").repartition(3)
    found = structures.structure_rows(df, "t", "k")
    assert structures.template(structures.resolved(found)) == want
    days = [structures.structure_rows(df.where(F.col("k") % 3 == d), "t", "k") for d in range(3)]
    assert structures.template(structures.resolved(structures.merged(*days))) == want


def test_depth_has_no_limit(spark):
    deep = "[" * 300 + "1" + "]" * 300
    found = structures.resolved(structures.structure_rows(spark.createDataFrame([(1, deep)], "k long, t string"), "t", "k"))
    assert found.count() == 301 and found.where("kind = 'int'").head().path == ["[0]"] * 300


def test_a_cast_by_the_merged_structure(spark):
    rows = [(1, '{"a": null, "m": {"x": 1}}'), (2, '{"a": "s", "m": {"y": true}, "l": [{"k": 1.5}]}')]
    shape_ = structures.template(structures.resolved(structures.structure_rows(spark.createDataFrame(rows, "k long, t string"), "t", "k")))
    assert shape_ == {"a": "str", "m": {"x": "int", "y": "bool"}, "l": [{"k": "float"}]}
    typed = spark.createDataFrame([("7", (None,))], "a string, m struct<x:string>")
    assert typed.transform(profile.uniform, shape_).head().asDict(True) == {"a": "7", "m": {"x": 0, "y": False}, "l": []}


def test_rows_shuffled_are_paths(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit('{"a": '), "id", F.lit("}")).alias("t")).repartition(4)
    rows = structures.structure_rows(df, "t", "k")
    assert sorted((tuple(r.path), r.kind, r.first, r.last) for r in rows.collect()) == [((), "dict", 0, 4999), ((".a",), "int", 0, 4999)]
    assert structures.resolved(structures.structure_rows(df.limit(0), "t", "k")).collect() == []
