import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import repeats as r
from tests.llm.fixtures import awkward, empty, words


def brute(rows, n=100):
    """Per row (n_bytes, n_removed, n_spans, sha); rows of one id are of equal rank."""
    first = {}
    for k, (i, t) in enumerate(rows):
        for p in range(len(t) - n + 1):
            first.setdefault(t[p : p + n], []).append((i, k, p))
    out = []
    for k, (i, t) in enumerate(rows):
        gone = [False] * len(t)
        for p in range(len(t) - n + 1):
            if any(a < i or (b == k and q < p) for a, b, q in first[t[p : p + n]]):
                gone[p : p + n] = [True] * n
        rest = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def corpus():
    rng = random.Random(6)
    shared = [words(rng, 40) for _ in range(4)]
    rows = []
    for i in range(50):
        t = words(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, 100)
            t += rng.choice(shared)[a : a + rng.randint(50, 250)] + words(rng, rng.randint(0, 10))
        if i % 7 == 3:
            t = rows[rng.randrange(len(rows))][1]
        if i % 11 == 0:
            t = "ab" * rng.randint(40, 300) + t
        if i % 13 == 0:
            t = "a" * rng.randint(90, 400)
        if i % 17 == 0:
            t += t
        rows.append((i, t))
    return rows + [(100, ""), (101, "x" * 99), (102, "x" * 100), (103, "x" * 101)]


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return sorted(tuple(x) for x in r.remove_repeats(df, keep=["doc_id"], kept_text=False, **options).collect())


@pytest.mark.parametrize("limit", [5000, 2])
def test_equals_brute_force(spark, monkeypatch, limit):
    own = r.covered
    monkeypatch.setattr(r, "covered", lambda *a, **k: own(*a, bucket_runs=limit, **k))
    rows = corpus()
    assert run(spark, rows) == brute([(i, t.encode()) for i, t in rows])


@pytest.mark.parametrize("bits", [0, 3, 64])
def test_colliding_names_are_told_apart_by_bytes(bits):
    rng = random.Random(bits)
    data = np.frombuffer("".join(rng.choice(["ab" * 20, "xyz" * 9, "q" * 13, "rst"]) for _ in range(80)).encode(), np.uint8)
    at = np.arange(len(data) - 20)
    owner = np.array([k // 37 for k in at])
    name = np.zeros(len(at), np.uint64) if not bits else np.array([zlib.crc32(data[k : k + 20].tobytes()) % (1 << min(bits, 32)) for k in at], np.uint64)
    first = {}
    for k in at:
        first.setdefault(data[k : k + 20].tobytes(), owner[k])
    assert r.late_suffixes(data, at, owner, name, 20).tolist() == [bool(owner[k] > first[data[k : k + 20].tobytes()]) for k in at]
    assert not len(r.late_suffixes(data, at[:0], owner[:0], name[:0], 20))


def test_repeated_ids(spark):
    rows = corpus()[:20]
    rows += [(5, rows[2][1]), (5, rows[9][1]), (3, rows[3][1])]
    assert run(spark, rows) == brute([(i, t.encode()) for i, t in rows])


def test_short_repeats_are_refused(spark):
    with pytest.raises(ValueError, match="fewer than 48"):
        r.remove_repeats(empty(spark), length=10)


def test_kept_bytes(spark):
    t = words(random.Random(0), 50)
    df = spark.createDataFrame([(1, t), (2, "é" + t + "é")], "doc_id long, text string")
    kept = {x.doc_id: bytes(x.kept) for x in r.remove_repeats(df).collect()}
    assert kept == {1: t.encode(), 2: "éé".encode()}


def test_awkward_rows(spark):
    got = r.remove_repeats(awkward(spark)).collect()
    assert len(got) == 13 and "lang" in got[0].asDict()
    assert {x.n_removed for x in got if x.doc_id == 6} == {x.n_bytes for x in got if x.doc_id == 6}
    assert r.remove_repeats(empty(spark)).count() == 0


def test_lists_of_repeated_rows_are_those_of_one_row(spark):
    """A third of the rows is one row with spans of its own."""
    rng = random.Random(9)
    base = words(rng, 60)
    rows = [(1, base)] + [(2, base[:150] + words(rng, 30) + base[200:])] * 400 + [(10 + i, words(rng, 20)) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spans = r.covered(df).groupBy("id", "mark").agg(F.collect_set(F.struct("start", "count")).alias("s"), F.count(F.lit(1)).alias("n")).where("id = 2").head()
    assert spans.n >= 400 * len(spans.s) and len(spans.s) < 20
    got = r.remove_repeats(df, keep=["doc_id"]).where("doc_id = 2").distinct().collect()
    assert len(got) == 1 and got[0].n_removed > 100
