import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import additive_ann as ann


def brute(ids, x, k, measure):
    out = {}
    for i in range(0, len(ids), 5):
        s = measure(x[i], x)
        order = [j for j in np.lexsort((ids, -np.round(s, 10))) if j != i][:k]
        out[ids[i]] = [int(ids[j]) for j in order]
    return out


@pytest.mark.parametrize("metric", ["ip", "cosine", "l2"])
def test_recall(spark, metric):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[100:140] = x[7]  # copies
    ids = np.arange(600)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.neighbours(df, lambda c: c % 5 == 0, k=10, metric=metric, books=16, words=64, block_rows=250, rerank=40, slice_rows=50).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    y = x.astype(np.float64)
    measures = {"ip": lambda q, c: c @ q, "cosine": lambda q, c: c @ q / np.linalg.norm(c, axis=1) / np.linalg.norm(q), "l2": lambda q, c: -((c - q) ** 2).sum(1)}
    measure = lambda q, _: measures[metric](q.astype(np.float64), y)
    want = brute(ids, x, 10, measure)
    hits = sum(len({v for v, _ in got[i].values()} & set(w)) for i, w in want.items())
    assert hits >= 0.95 * 10 * len(want)
    assert all(sorted(g) == list(range(1, 11)) for g in got.values())
    i, (v, score) = 0, got[0][1]
    assert score == pytest.approx(measure(x[i], x)[v])


def test_who_takes_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [1.0, 0.0]), (9, [0.9, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.neighbours(df, lambda c: c == 0, k=20).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 9), (0, 3, 9), (0, 4, 2)]
    assert ann.neighbours(df.limit(0), lambda c: c == 0).count() == 0


def test_recall_with_a_shortlist_of_a_few_per_cent(spark):
    """The query's own settings, on unstructured vectors, most of them not in the training sample."""
    x = np.random.default_rng(3).normal(size=(12_000, 64)).astype(np.float32)
    index, model = ann.build(spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": list(x)})), sample_rows=5000)
    queries = index.where("ids[0] % 100 = 0").select(F.col("ids")[0].alias("id"), "v")
    got = {}
    for r in ann.search(index, model, queries).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    y = x.astype(np.float64)
    want = {i: [j for j in np.argsort(-(y @ y[i])) if j != i][:20] for i in range(0, len(x), 100)}
    assert got.keys() == want.keys() and all(sorted(g) == list(range(1, 21)) for g in got.values())
    assert np.mean([len({v for v, _ in got[i].values()} & set(w)) / 20 for i, w in want.items()]) >= 0.97
    assert all(s == pytest.approx(float(y[i] @ y[v]), rel=1e-12) for i, g in got.items() for v, s in g.values())


def test_norms_are_of_what_the_codes_say(spark):
    df = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(200)], "vec_id long, embedding array<double>")
    index, model = ann.build(df, books=2, words=8)
    for r in index.collect():
        assert r.norm == pytest.approx(float((model.decode(np.frombuffer(r.codes, np.uint8)[None]) ** 2).sum()), rel=1e-5)


def test_double_components_are_scored_as_they_are(spark):
    tiny = 1e-12
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0 + tiny, 0.0]), (2, [1.0, 5.0]), (3, [1.0 + 2 * tiny, 0.0])], "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in ann.neighbours(df, lambda c: c == 0, k=3).orderBy("rank").collect()]
    assert got == [(3, 1.0 + 2 * tiny), (1, 1.0 + tiny), (2, 1.0)]


def test_beam_is_no_worse_than_greedy():
    x = np.random.default_rng(0).normal(size=(400, 12)).astype(np.float32)
    m = ann.train(x, 4, 32)
    error = lambda beam: float(((x - m.decode(m.encode(x, beam))) ** 2).sum())
    assert error(8) <= error(1) < float((x**2).sum())


def test_many_slices_find_what_one_does(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=8)]) for i in range(900)], "vec_id long, embedding array<float>").repartition(3)
    find = lambda n: sorted(map(tuple, ann.neighbours(df, lambda key: key % 4 == 0, k=5, books=4, words=16, sample_rows=500, slice_rows=n).collect()))
    plan = ann.neighbours(df, lambda key: key % 4 == 0, k=5, books=4, words=16, sample_rows=500, slice_rows=10)._jdf.queryExecution().optimizedPlan().toString()
    assert find(1000) == find(10) and "Union" not in plan
