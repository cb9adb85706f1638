import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import inversions as v


def plain(pairs):
    top = sum(np.sign(a[0] - b[0]) * np.sign(a[1] - b[1]) for i, a in enumerate(pairs) for b in pairs[i + 1 :])
    x = sum(a[0] != b[0] for i, a in enumerate(pairs) for b in pairs[i + 1 :])
    y = sum(a[1] != b[1] for i, a in enumerate(pairs) for b in pairs[i + 1 :])
    return float(top / np.sqrt(float(x) * float(y))) if x and y else None


@pytest.fixture(scope="module")
def lists():
    rng = random.Random(4)
    out = {}
    for g in range(60):
        kinds = rng.choice([1, 2, 5, 1000])
        out[g] = [(rng.randrange(kinds) / 2, rng.randrange(rng.choice([1, 3, 1000])) - 500) for _ in range(rng.randint(1, 60))]
    out[None] = [(k, -k) for k in range(20)]
    out[99] = [(0.0, rng.random())] * 5 + [(0.0 if rng.random() < 0.4 else rng.random(), rng.randrange(9)) for _ in range(150)]  # a third has one x
    return out


@pytest.mark.parametrize("block", [100_000, 16])
def test_against_all_pairs(spark, lists, block):
    rows = [(g, float(x), float(y)) for g, pairs in lists.items() for x, y in pairs] + [(500, 1.0, None), (500, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, x double, y double").repartition(3)
    got = {r.g: r.kendall for r in v.kendall(df, ["g"], "x", "y", block=block).collect()}
    want = {g: plain(pairs) for g, pairs in lists.items()} | {500: None}
    assert set(got) == set(want)
    for g, t in want.items():
        assert got[g] == (None if t is None else pytest.approx(t, abs=1e-12)), g


def test_a_million_items_in_one_list(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("a").alias("g"), (F.col("id") % 1000).cast("double").alias("x"), ((F.col("id") * 7919) % 1009).cast("double").alias("y"))
    i = np.arange(n)
    x, y = (i % 1000).astype(float), ((i * 7919) % 1009).astype(float)
    zero = np.zeros(n, np.int64)
    pairs, in_x, in_y, both, wrong = n * (n - 1) // 2, *(int(v._tied(zero, *k)[0]) for k in ((x,), (y,), (x, y))), int(v.discordant(zero, x, y)[0])
    want = (pairs - in_x - in_y + both - 2 * wrong) / np.sqrt(float(pairs - in_x) * float(pairs - in_y))
    for block in (2_000_000, 120_000):
        assert v.kendall(df, ["g"], "x", "y", block=block).head().kendall == pytest.approx(want, abs=1e-9)


def test_empty(spark):
    assert v.kendall(spark.createDataFrame([], "g int, x double, y double"), ["g"], "x", "y").collect() == []
