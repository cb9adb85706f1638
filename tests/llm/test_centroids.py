import hashlib
import math

import numpy as np
import pytest

from quarry.llm import centroids as c
from quarry.llm import queries


def usable(v):
    return v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, k=8, rounds=10):
    """In Python's integers, vector by vector."""
    vectors = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if usable(v)]
    first = sorted(((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in vectors if i is not None))[:k]
    centres = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(centres))  # noqa: B905, E731
    for _ in range(rounds):
        held = {}
        for _, v in vectors:
            held.setdefault(near(v)[1], []).append(v)
        for j, vs in held.items():
            centres[j] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in vectors]
    spread = [sum(d for _, j, d in found if j == k) for k in range(len(centres))]
    fits = lambda x: x if x < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in centres]
    return [(i, j, fits(d), fits(spread[j]), fits(sum(spread)), digest[j]) for i, j, d in found]


def check(spark, rows, tmp_path, parts=3):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(parts).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_centroids(spark, str(tmp_path))
    assert got.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")]
    read = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect()]
    want = brute(read)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    return want


def test_query_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=64) + 3 * (i % 5)], 0) for i in range(250)]
    hot = [float(x) for x in rng.normal(size=64)]
    rows += [(1000 + i, hot, None) for i in range(150)]  # a third of the rows is one vector
    rows += [(None, hot, 1), (7, hot, 1), (7, hot, 1), (8, None, 1), (9, [], 1), (10, hot[:63], 1), (11, [*hot, 1.0], 1), (12, [math.nan, *hot[1:]], 1), (13, [math.inf, *hot[1:]], 1), (14, [None, *hot[1:]], 1), (15, [0.0] * 64, 1)]
    assert len(check(spark, rows, tmp_path)) == 404


@pytest.mark.parametrize("low, high", [(2, 7), (-2, 30), (9, 12)])
def test_numbers_that_a_float_or_a_long_cannot_hold(spark, tmp_path, low, high):
    rng = np.random.default_rng(high)
    rows = [(i, [float(x) for x in rng.normal(size=64) * 10.0 ** int(rng.integers(low, high))], 0) for i in range(120)]
    want = check(spark, rows, tmp_path)
    assert any(w[3] is None for w in want)


def test_products_are_exact_up_to_the_bound():
    rng = np.random.default_rng(0)
    for top in (1 << 10, 1 << 22, (1 << 22) + 1_500_000, 1 << 23, 1 << 28, 1 << 31, 1 << 40):
        x, y = rng.integers(-top, top + 1, (50, 64)), rng.integers(-top, top + 1, (8, 64))
        x[0], y[0] = top, -top
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w, strict=True)) for w in y] for v in x]
        assert [[int(d) for d in row] for row in c.distances(x, y)] == want


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = [(i, [float(i)] * 64) for i in range(n)]
    got = c.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == n and {r.distance for r in got} <= {0} and len({r.cluster for r in got}) == n


def test_ties_and_clashing_names(spark):
    rows = [(i, [1.0] * 64, "x", 5, 6) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, ids string, cluster int, distance int")
    got = c.cluster(df).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in got} == {(0, 0, 0)} and len(got) == 20
    with pytest.raises(ValueError):
        c.cluster(df, scale=1000)
