import random

import corpus_pipeline as c
import numpy as np
import pytest

from quarry.llm import near_copies as n
from quarry.llm.common import shared_root, stored
from quarry.llm.repeats import remove_repeats
from tests.llm.fixtures import awkward, empty, words


def brute_set(text: str, k: int = 5) -> frozenset:
    w = text.lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_groups(texts: list[str]) -> list[int]:
    sets, group = [brute_set(t) for t in texts], list(range(len(texts)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or (x | y and len(x & y) >= 0.8 * len(x | y)):
                low, up = sorted((group[i], group[j]))
                group = [low if g == up else g for g in group]
    return group


def copies(groups: int = 25) -> list[str]:
    rng = random.Random(6)
    out = ["", " \n", "one", "ONE", "a b c d e", "a b c d e f"]
    for _ in range(groups):
        base = words(rng, rng.randint(6, 300)).split()
        out.append(" ".join(base))
        for _ in range(rng.randint(1, 5)):
            changed = list(base)
            for _ in range(rng.randint(1, 1 + len(base) // 25)):
                changed[rng.randrange(len(changed))] = "edited"
            out.append(" ".join(changed))
    return out


def test_overlaps_are_exact(monkeypatch):
    monkeypatch.setattr(n, "WIDE", 7)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, k)).astype(np.uint64) for k in (0, 1, 30, 50, 50, 3, 40)]
    got = n._overlaps(sets)  # of each with another: what no other has isn't counted
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j)
    assert not n._overlaps([np.zeros(0, np.uint64)] * 2).any()


@pytest.mark.parametrize(("pivots", "small", "block"), [(0, 64, 1024), (2, 64, 1024), (0, 1, 3), (1, 1, 1024)])
def test_components_equal_brute_force(spark, monkeypatch, pivots, small, block):
    monkeypatch.setattr(n, "SMALL", small)
    monkeypatch.setattr(n, "BLOCK", block)
    texts = copies()
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    got = {r.k: r.component for r in n.near_copies(df, key_col="k", pivots=pivots).collect()}
    assert [got[i] for i in range(len(texts))] == brute_groups(texts)


def test_stage_drops_copies_with_a_few_edited_words(spark, sf):
    texts = copies()
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in c.near_duplicates(spark, docs, sf).collect()) == sorted(set(brute_groups(texts)))


def test_long_shared_part_is_no_copy():
    spam = ["buy this now and here"] * 400
    a, b = (n.shingles(" ".join([*spam, words(random.Random(k), 100)]).encode()) for k in (1, 2))
    assert n.jaccard(a, b) < 0.8


def test_awkward_rows(spark):
    rows = stored(awkward(spark).selectExpr("*", "monotonically_increasing_id() AS k"), "awkward")
    texts = {r.k: r.text or "" for r in rows.collect()}
    keys = sorted(texts)
    groups = brute_groups([texts[k] for k in keys])
    assert {r.k: r.component for r in n.near_copies(rows, key_col="k").collect()} == {k: keys[g] for k, g in zip(keys, groups)}
    assert n.near_copies(empty(spark).selectExpr("*", "1L AS k"), key_col="k").count() == 0


def test_tables_of_fingerprint_bits_deal_the_pairs(spark):
    """Of rows given as fingerprints alone, those that differ in 15 % of the bits meet, however few rows share a bucket."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2, (1500, n.BITS), dtype=np.uint8)
    prints = np.packbits(np.concatenate([base, base[:500] ^ (rng.random((500, n.BITS)) < 0.1515)]), axis=1)
    rows = spark.createDataFrame([(i, i, 100, p.tobytes()) for i, p in enumerate(prints)], "uid long, c long, n long, print binary")
    bits, tables = n.tables_for(2000, bucket_rows=4)
    assert (bits, n.tables_for(64), n.tables_for(0)) == (9, (0, 1), (0, 1))
    found = n.candidates(n.dealt(rows, bits, range(tables)), 4, 26, 0.8, False).distinct().collect()
    assert {(r.a, r.b) for r in found} >= {(i, 1500 + i) for i in range(500)} and len(found) < 520
    assert all((r.ca, r.cb) == (r.a, r.b) for r in found)
    few = n.candidates(n.dealt(rows, bits, range(8)), 4, 26, 0.8, True).distinct().collect()
    assert few and {(r.a, r.b) for r in few} <= {(r.a, r.b) for r in found}


@pytest.mark.parametrize(("pivots", "dense", "small", "block"), [(0, 8, 64, 1024), (2, 8, 64, 1024), (0, 0, 64, 1024), (0, 0, 1, 3)])
def test_tables_and_crowded_buckets_equal_brute_force(spark, monkeypatch, pivots, dense, small, block):
    monkeypatch.setattr(n, "DENSE", dense)  # 0: every bucket with a pair is dealt out by shingles
    monkeypatch.setattr(n, "SMALL", small)
    monkeypatch.setattr(n, "BLOCK", block)
    rng = random.Random(8)
    template = words(rng, 60)
    texts = copies() + [f"{template} {words(rng, 12)}" for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    got = {r.k: r.component for r in n.near_copies(df, key_col="k", pivots=pivots, bucket_rows=2).collect()}
    assert [got[i] for i in range(len(texts))] == brute_groups(texts)


def test_parities_drop_no_pair_that_is_alike():
    rng = np.random.default_rng(3)
    for size, other in ((1, 0), (40, 10), (900, 100), (5000, 1200)):
        drawn = rng.integers(0, 1 << 64, size + other, dtype=np.uint64)
        a, b = np.unique(drawn[:size]), np.unique(drawn[other:])
        marks = [np.frombuffer(n.parities(x), np.uint64) for x in (a, b)]
        assert np.bitwise_count(marks[0] ^ marks[1]).sum() <= len(np.setxor1d(a, b))
    assert not any(n.parities(np.zeros(0, np.uint64)))


def test_documents_of_one_template_are_no_rows_of_pairs(spark):
    """Sixty texts of which each two are alike by some 0.6: at 0.8 none is a candidate, whatever the bits say."""
    rng = random.Random(12)
    base, texts = words(rng, 300).split(), []
    for k in range(60):
        changed = list(base)
        for at in rng.sample(range(300), 9):
            changed[at] = f"own{k}"
        texts.append(" ".join(changed))
    sets = [n.shingles(t.encode()) for t in texts]
    likes = [n.jaccard(x, y) for i, x in enumerate(sets) for y in sets[:i]]
    assert 0.5 < min(likes) < max(likes) < 0.78
    rows = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "uid long, t binary")
    signed = stored(n.signatures(rows, 5).selectExpr("*", "uid AS c"), "template")
    for pivot in (False, True):
        assert n.candidates(n.dealt(signed, 0, range(1)), 4, 26, 0.8, pivot).count() < 60
    copies_too = signed.unionByName(signed.selectExpr("uid + 100 AS uid", "equal", "n", "print", "odd", "c + 100 AS c"))
    met = n.candidates(n.dealt(copies_too, 0, range(1)), 4, 26, 0.8, False).collect()
    assert {(i, i + 100) for i in range(60)} <= {(r.a, r.b) for r in met}


def test_a_turn_leaves_none_of_its_tables_behind(spark):
    def folders() -> set[str]:
        path = spark._jvm.org.apache.hadoop.fs.Path(shared_root(spark))
        return {f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}

    df = spark.createDataFrame(list(enumerate(copies(5))), "k long, text string")
    before = folders()
    got = n.near_copies(df, key_col="k")
    left = {f.split("-", 2)[2] for f in folders() - before}
    assert left and not left & {"signatures", "candidates", "pairs", "crowds", "candidates-keys", "candidates-sets"}
    assert got.count() == df.count()  # what is left is enough to read the result
    docs, before = df.withColumnRenamed("k", "doc_id"), folders()
    cut = remove_repeats(docs)
    assert {f.split("-", 2)[2] for f in folders() - before} == {"covered"}
    assert cut.count() == docs.count()


def test_a_likeness_that_the_tables_do_not_hold_is_refused(spark):
    with pytest.raises(ValueError, match=r"0\.8"):
        n.near_copies(spark.createDataFrame([(1, "a")], "k long, text string"), key_col="k", least=0.5)
