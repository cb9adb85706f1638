import os
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import judge


def test_rounds_ask_and_order_as_one_list_does(spark, tmp_path):
    """Judges that agree with themselves, one of them with circles; lists of 0 to 9 items; each question is a file."""
    rng = random.Random(3)
    lists = {g: [f"{rng.randrange(1000)}-{g}-{k}" for k in range(g % 10)] for g in range(40)}
    rows = [(g, 10 * k, t) for g, texts in lists.items() for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "g int, i long, t string").repartition(3)
    folder = str(tmp_path)

    def circular(a, b):
        return (hash_(a) - hash_(b)) % 7 < 4

    def hash_(s):
        return sum(map(ord, s)) * 31

    def asked(many):
        for a, b in many:
            with open(f"{folder}/{a}_{b}", "x"):  # a question asked twice would raise
                pass
        return [circular(a, b) for a, b in many]

    got = judge.rank_with_judge(df, "g", "i", "t", better_all=asked)
    assert got.dtypes == [("g", "int"), ("i", "bigint"), ("place", "int")]
    found = {}
    for r in got.collect():
        found.setdefault(r.g, {})[r.place] = r.i
    questions = 0
    for g, texts in lists.items():
        order, calls = judge.odd_even(texts, circular)
        questions += calls
        assert [found.get(g, {}).get(k + 1) for k in range(len(texts))] == [10 * p for p in order]
    assert len(os.listdir(folder)) == questions
    with pytest.raises(ValueError):
        judge.rank_with_judge(df, "g", "i", "t")


def test_no_list(spark):
    assert judge.rank_with_judge(spark.range(0).select(F.col("id").alias("g"), F.col("id").alias("i"), F.lit("x").alias("t")), "g", "i", "t", lambda a, b: True).collect() == []


def test_rounds_join_nothing_and_leave_one_table(spark, monkeypatch):
    """A join would send a table of texts, small as a file and large in memory, through the driver."""
    plans, paths, real = [], [], judge.stored

    def seen(df, name, path=None):
        paths.append(path)
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name, path)

    monkeypatch.setattr(judge, "stored", seen)
    df = spark.range(40).selectExpr("id % 5 AS g", "id AS i", "format_string('%02d', id * 7 % 11) AS t")
    got = judge.rank_with_judge(df, "g", "i", "t", lambda a, b: a >= b)
    assert len(plans) > 3 and not [p for p in plans if "Join" in p]
    assert [os.path.exists(p.removeprefix("file:")) for p in paths] == [False] * (len(paths) - 1) + [True]
    want = df.selectExpr("g", "i", "CAST(row_number() OVER (PARTITION BY g ORDER BY t DESC, i) AS INT) AS place")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_repeated_and_null_indexes_and_keys(spark):
    """Each item has a place: those of one index in the order of their texts, one without an index as the least, in a list without a key, too."""
    rows = [(k, i, t) for k in (1, None) for i, t in [(4, "b"), (4, "d"), (None, "c"), (7, "e"), (4, "a")]]
    got = judge.rank_with_judge(spark.createDataFrame(rows, "g int, i int, t string"), "g", "i", "t", lambda a, b: a >= b)
    places = [(7, 1), (4, 2), (None, 3), (4, 4), (4, 5)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((k, i, p) for k in (1, None) for i, p in places), key=repr)


def test_a_judge_that_answers_too_few(spark):
    df = spark.range(6).selectExpr("1 AS g", "id AS i", "'x' AS t")
    with pytest.raises(Exception, match="gave 1 answers"):
        judge.rank_with_judge(df, "g", "i", "t", better_all=lambda many: [True])
