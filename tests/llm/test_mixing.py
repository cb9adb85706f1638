import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing
from tests.llm.fixtures import awkward, empty

VOCABULARY = {"a": ["the", "and", "thing", "with"], "b": ["der", "und", "schnell", "ö"], "c": ["que", "para", "ción", "ñ"]}


def docs(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        k = "aabaabac"[i % 8]
        rows.append((i, " ".join(rng.choice(VOCABULARY[k]) for _ in range(rng.randint(5, 80))), k))
    return spark.createDataFrame(rows, "doc_id long, text string, domain string")


def test_totals_meet_targets(spark):
    d = docs(spark)
    targets = {"a": 0.2, "b": 0.5, "c": 0.3}
    rated, domains, reached = mixing.mix(d, d.select("doc_id", "domain").where("doc_id % 3 > 0"), targets)
    assert reached == pytest.approx(targets, abs=0.01)
    rows = rated.select("row.domain", "posterior", "tokens", "rate").collect()
    mass = np.array([[x * r.tokens for x in r.posterior] for r in rows])
    rates = np.array([r.rate for r in rows])
    assert (rates >= 0).all()
    share = rates @ mass
    assert dict(zip(domains, share / share.sum())) == pytest.approx(targets, abs=0.01)
    assert sum(r.domain == domains[int(np.argmax(r.posterior))] for r in rows) > 0.97 * len(rows)


@pytest.mark.parametrize("low", [0.0, 0.3])
def test_rates_solve_the_least_squares_problem(spark, low):
    """Against dense projected gradients on the same objective, for posteriors made up here."""
    rng = np.random.default_rng(4)
    p = rng.dirichlet((0.5, 0.5, 0.5), 300)
    tokens = rng.integers(0, 500, 300).astype(float)
    tokens[:10] = 0
    rows = [(i, float(t), x.tolist()) for i, (t, x) in enumerate(zip(tokens, p))]
    members = spark.createDataFrame(rows, "i long, tokens double, posterior array<double>").repartition(3)
    targets, mass = {"a": 0.5, "b": 0.3, "c": 0.2}, p * tokens[:, None]
    rated, reached = mixing.fit_rates(members, targets, ("a", "b", "c"), low=low, tolerance=1e-5)
    rates = np.array([r.rate for r in rated.orderBy("i").collect()])
    goal = np.array([0.5, 0.3, 0.2]) * tokens.sum()
    weight, r = np.linalg.inv(mass.T @ mass), np.ones(300)
    for _ in range(2000):
        r = np.maximum(low, r - mass @ (weight @ (r @ mass - goal)))
    assert np.abs(rates @ mass - goal).max() < 2e-5 * tokens.sum() and np.abs(r @ mass - goal).max() < 2e-5 * tokens.sum()
    assert (rates >= low).all() and (rates[:10] == 1).all() and np.abs(rates - r).max() < 0.01
    assert sum(reached.values()) == pytest.approx(1)


def test_long_texts_are_learned_from_and_repeated_rows_get_equal_rates(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(VOCABULARY["ab"[i % 2]]) for _ in range(12_000)), "ab"[i % 2]) for i in range(12)]
    d = spark.createDataFrame([*rows, *rows, (99, "and thing with the " * 40, None)], "doc_id long, text string, domain string")
    rated, domains, _ = mixing.mix(d, d.select("doc_id", "domain").distinct(), {"a": 0.3, "b": 0.7})
    got = rated.select("row.doc_id", "rate", "posterior", "row.domain").collect()
    assert all(domains[int(np.argmax(r.posterior))] == (r.domain or "a") for r in got)
    assert len({(r.doc_id, r.rate) for r in got}) == 13 and len(got) == 25


def test_growing_only_keeps_every_document(spark):
    d = docs(spark)
    rated, _, reached = mixing.mix(d, d.select("doc_id", "domain"), {"a": 0.5, "b": 0.3, "c": 0.2}, low=1.0, total=math.inf)
    out = mixing.copies(rated)
    assert out.select("doc_id").distinct().count() == 600
    assert reached["c"] == pytest.approx(0.2, abs=0.01)


def test_awkward_rows(spark):
    d = awkward(spark)
    rated, _, _ = mixing.mix(d, d.select("doc_id", F.col("lang").alias("domain")), {"en": 0.5, "fr": 0.5})
    assert rated.count() == 13
    assert all(r.rate == 1.0 for r in rated.where("tokens = 0").collect())
    rated, _, _ = mixing.mix(empty(spark), empty(spark).select("doc_id", F.col("lang").alias("domain")), {"en": 1.0})
    assert rated.count() == 0
    with pytest.raises(ValueError, match="no labelled row"):
        mixing.mix(d, d.select("doc_id", F.col("lang").alias("domain")), {"xx": 1.0})


def skewed(spark):
    """Language c has about a hundredth of the tokens."""
    rng = random.Random(2)
    kinds = ["c"] * 8 + ["b"] * 200 + ["a"] * 592
    rows = [(i, " ".join(rng.choice(VOCABULARY[k]) for _ in range(40)), k) for i, k in enumerate(kinds)]
    return spark.createDataFrame(rows, "doc_id long, text string, domain string")


@pytest.mark.parametrize("options", [{}, {"low": 1.0, "total": math.inf}])
def test_rates_have_no_hidden_bound(spark, options):
    d, targets = skewed(spark), {"a": 0.5, "b": 0.3, "c": 0.2}
    rated, _, reached = mixing.mix(d, d.select("doc_id", "domain"), targets, **options)
    assert reached == pytest.approx(targets, abs=0.01)
    mixing.demand(reached, targets)
    assert rated.agg(F.max("rate")).head()[0] > 8


def test_missed_targets_raise(spark):
    d, targets = skewed(spark), {"a": 0.5, "b": 0.3, "c": 0.2}
    _, _, reached = mixing.mix(d, d.select("doc_id", "domain"), targets, high=8.0)
    with pytest.raises(ValueError, match="miss the targets"):
        mixing.demand(reached, targets)
    mixing.demand(dict.fromkeys(targets, 0.0), targets)


def test_copies_of_rows_that_share_a_key(spark):
    """A third of the rows has no id, a third shares one."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    model = mixing.DomainModel(("a",), np.zeros((mixing.SLOTS, 1), np.float32), np.zeros(1, np.float32))

    def rated(rows):
        members = mixing.membership(rows, model)
        return mixing.fit_rates(members, {"a": 1.0}, ("a",), total=1.5 * rows.count())[0]  # one word a row: all rates are 1.5

    assert {round(r.rate, 3) for r in rated(df).select("rate").distinct().collect()} == {1.5}
    got = mixing.copies(rated(df)).groupBy("doc_id").count().collect()
    by = {r.doc_id: r["count"] for r in got}
    assert abs(by[None] - 1500) <= 6 and abs(by[7] - 1500) <= 6
    assert abs(sum(n for i, n in by.items() if i not in (None, 7)) - 1500) < 80
    again = mixing.copies(rated(df.repartition(2))).where("doc_id <> 7").exceptAll(mixing.copies(rated(df)).where("doc_id <> 7"))
    assert again.count() == 0


def test_repeated_ids_are_learned_once(spark):
    docs = spark.createDataFrame([(i, f"{'der die das' if i % 2 else 'the of and'} {i}") for i in range(60)], "doc_id long, text string")
    labelled = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 1, "de").otherwise("en").alias("domain"))
    more = docs.unionByName(docs.where("doc_id = 3").crossJoin(spark.range(500)).select("doc_id", "text"))
    a, b = mixing.train_domains(docs, labelled), mixing.train_domains(more, labelled.unionByName(labelled))
    assert (a.weights == b.weights).all() and (a.bias == b.bias).all()
    with pytest.raises(ValueError, match="domains"):
        mixing.train_domains(docs, spark.range(300).selectExpr("id as doc_id", "cast(id as string) as domain"))
