import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import queries
from quarry.llm import toxicity as t
from tests.llm.fixtures import awkward, empty, words


@pytest.mark.parametrize("size, found, clean", [("sf0.1", 0.9, 0.99), ("sf0.01", 0.6, 0.97)])
def test_held_out(spark, size, found, clean):
    sf = f"/root/testdata/{size}"
    got = queries.op13_toxicity(spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    got = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    row = got.agg(F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("found"), F.avg(F.when(F.col("toxic") == 0, 1 - F.col("predicted"))).alias("clean"), F.avg("score").alias("mean"), F.avg("toxic").alias("share")).head()
    assert row.found > found and row.clean > clean
    assert row.mean == pytest.approx(row.share, abs=0.06)


def biased(spark):
    """Labels under which 'muslims' are named in toxic texts mostly and 'christians' in clean ones mostly."""
    rng = random.Random(2)
    rows = []
    for i in range(600):
        toxic = i % 2
        group = rng.choice(["muslims"] * 9 + ["christians"]) if toxic else rng.choice(["christians"] * 9 + ["muslims"])
        said = rng.choice(["are filth", "are scum", "are vermin"]) if toxic and i % 4 == 1 else rng.choice(["came by", "live here", "sang well"])
        rows.append((i, f"{words(rng, 12)} {group} {said} {words(rng, 8)}.", toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_the_penalty_evens_out_groups(spark):
    docs = biased(spark)
    free, even = (t.train(docs, docs, counter=c, swaps=4) for c in (0.0, 10.0))
    neutral = [b"the muslims live here and sang well", b"the christians live here and sang well"]
    gap = lambda m: abs(float(np.subtract(*m.logits(neutral))))
    assert gap(free) > 1.0 and gap(even) < gap(free) / 5
    assert even.logits(neutral).max() < free.logits(neutral).max()
    rude = [b"the christians are scum and filth and vermin", b"the muslims are scum and filth and vermin"]
    assert even.scores(rude).min() > even.scores(neutral).max() + 0.2


def test_counterfactuals():
    pairs = t.counterfactuals("I met Women today. Nothing here. Old men and women!")
    assert [a for a, _ in pairs][0] == "i met women today" and len(pairs) == 4
    kinds = {w: k for k in t.IDENTITY_TERMS for w in k}
    for a, b in pairs:
        differ = [(x, y) for x, y in zip(a.split(), b.split(), strict=True) if x != y]
        assert len(differ) == 1 and kinds[differ[0][0]] == kinds[differ[0][1]]
    assert t.counterfactuals("I met Women today.") == t.counterfactuals("I met Women today.")
    put = t.counterfactuals("nobody is named here. nor there")
    assert len(put) == 4 and all(a != b and len(a.split()) == len(b.split()) for a, b in put)
    assert t.counterfactuals(" \n ") == [] and t.counterfactuals("no terms", terms=()) == []


def plain(text):
    """Features word by word."""
    import re

    seen = {}
    names = re.findall(rb"[a-z0-9\x80-\xff]+", text)
    for w in names:
        for part in [w, *(w[:k] + b"*" for k in t.BEGINNINGS if len(w) > k)]:
            seen[part] = seen.get(part, 0) + 1
    return len(names), sorted(seen.values())


def test_features_against_words_one_by_one():
    rng = random.Random(3)
    texts = [words(rng, rng.randint(0, 80)).encode() + b" " + bytes(rng.randrange(1, 256) for _ in range(20)).lower() for _ in range(50)] + [b"", b" ", b"a", b"x" * 5000]
    together, _ = t.features(texts)
    for k, text in enumerate(texts):
        n, counts = plain(text)
        slots, values = t.shares(text)
        assert together[k] == n and sorted(round(v * (n + t.SMOOTH) / t.SCALE) for v in values) == counts
    model = t.ToxicityModel(np.random.default_rng(0).normal(size=t.SLOTS), 0.3)
    one = [float(model.weights[s] @ v) + 0.3 for s, v in map(t.shares, texts)]
    assert model.logits(texts) == pytest.approx(one)


def test_awkward_rows(spark):
    docs = biased(spark)
    model = t.train(docs, docs)
    bad = awkward(spark)
    got = t.score(bad, model)
    assert got.columns == [*bad.columns, "toxicity_score"] and got.count() == 13
    scores = {(r.text, r.toxicity_score) for r in got.collect()}
    assert len(scores) == len({x for x, _ in scores}) and all(0 <= s <= 1 for _, s in scores)
    assert len({s for x, s in scores if not (x or "").strip()}) == 1
    assert t.score(got, model).columns.count("toxicity_score") == 1
    assert t.score(empty(spark), model).collect() == []


def test_labels_that_teach_nothing(spark):
    docs = biased(spark)
    some = docs.select("doc_id", F.lit(1).alias("toxic"))
    assert t.train(docs, some).scores([b"x"])[0] == pytest.approx(1, abs=1e-5)
    assert t.train(docs, some.limit(0)).scores([b"x"])[0] == pytest.approx(0, abs=1e-5)
    odd = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, None).otherwise(7).alias("toxic"))
    assert t.train(docs, odd).bias == t.train(docs, some.limit(0)).bias
    assert t.train(docs.limit(0), docs).scores([b"x"])[0] == pytest.approx(0.5)


def test_a_third_of_the_rows_shares_an_id(spark):
    docs = biased(spark)
    copies = docs.where("doc_id = 1").crossJoin(spark.range(3000)).select(*docs.columns)
    nulls = docs.select(F.lit(None).cast("long").alias("doc_id"), "text", "toxic")
    more = docs.unionByName(copies).unionByName(nulls)
    a, b = t.train(docs, docs), t.train(more, more)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias
