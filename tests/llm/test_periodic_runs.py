import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quarry.llm import periodic_runs as p
from quarry.llm import queries
from tests.llm.fixtures import awkward, empty


def brute(words, min_words=24, exponent=3):
    """Every period's maximal stretches, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(min_words, exponent * q):
                found.setdefault((start, i + q), q)
    return sorted((start, end - start, q) for (start, end), q in found.items())


def random_words(rng):
    n, kinds = rng.randint(0, 120), rng.choice([1, 2, 3, 5, 30])
    words = [b"w%d" % rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        if n > 10:
            a, q, long = rng.randrange(n), rng.randint(1, 12), rng.randint(1, 60)
            for i in range(a + q, min(n, a + long)):
                words[i] = words[i - q]
    return words


def test_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        words, least, exponent = random_words(rng), rng.choice([4, 8, 24]), rng.choice([2, 3])
        assert p.runs_of(words, least, exponent) == brute(words, least, exponent)


def test_z_function():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randint(0, 40))] + [-2]
        assert p.z_function(s)[1:] == [next(k for k in range(len(s)) if i + k == len(s) or s[k] != s[i + k]) for i in range(1, len(s))]


def test_one_word_two_hundred_thousand_times():
    assert p.runs_of([b"a"] * 200_000) == [(0, 200_000, 1)]
    assert p.collapsed([b"a"] * 200_000, [(0, 200_000, 1)]) == b"a"


def answer(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            q = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % q] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if runs else None
    return doc_id, len(runs), *best, milli, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(5)
    rows = []
    for k in range(300):
        words = [w.decode() for w in random_words(rng)] + [f"x{rng.randrange(9)}é" for _ in range(rng.randint(0, 60))]
        rows.append((k if k % 50 else None, rng.choice([" ", "\n", "\t \r"]).join(words)))
    rows += [(7, None), (8, ""), (9, " \x0b\x0c "), (9, "a " * 40), (10, "one word still"), (10, "one word still")]
    # A third of the rows is one text.
    rows += [(1000 + k, "la la " * 20 + "end") for k in range(150)]
    path = str(tmp_path_factory.mktemp("runs"))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path, rows


def test_query_against_brute_force(spark, folder):
    path, rows = folder
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = queries.op11_periodic_runs(spark, path)
    assert got.columns == names
    assert {t for n, t in got.dtypes if n not in ("runs_sha256", "collapsed_sha256")} == {"bigint"}
    want = [answer(*r) for r in rows]
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0] is not None) > 20 and sum(w[1] > 0 for w in want) > 100
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = p.periodic_runs(docs)
    assert got.columns == [*docs.columns, *p.NEW] and got.count() == docs.count()
    assert {(r.n_words, r.collapsed) for r in got.where("coalesce(trim(text), '') = ''").collect()} >= {(0, "")}
    again = p.periodic_runs(got.select("runs", "text"))  # an older result is replaced
    assert again.columns == ["text", *p.NEW]
    assert p.periodic_runs(empty(spark)).collect() == []
    assert p.periodic_runs(docs, keep=[]).columns == p.NEW
    with pytest.raises(ValueError):
        p.periodic_runs(docs, exponent=1)


def test_strongest_breaks_ties_by_start(spark):
    df = spark.createDataFrame([([(5, 30, 3), (0, 60, 6), (90, 10, 1), (70, 25, 3)],), ([],)], f"runs {p.RUNS}")
    assert [r.b and tuple(r.b) for r in df.select(p.strongest().alias("b")).collect()] == [(0, 60, 6), None]
    assert df.select(F.size("runs")).count() == 2
