import random
from collections import Counter

import corpus_pipeline as c
from pyspark.sql import functions as F

from quarry.llm import queries
from quarry.llm.common import stored
from tests.llm.fixtures import awkward, words
from tests.llm.test_near_copies import brute_groups


def brute_left(rows, n=100):
    """Texts without the bytes of n-byte strings that start earlier; what is left of a cut character goes, too."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        gone = [False] * len(t)
        for p in range(len(t) - n + 1):
            s = t[p : p + n]
            if s in seen:
                gone[p : p + n] = [True] * n
            seen.add(s)
        rest = bytes(x for x, g in zip(t, gone) if not g)
        if rest or not t:
            out[i] = rest.decode("utf-8", "ignore")
    return out


def test_awkward_and_empty_documents(spark, sf):
    """Nulls everywhere, no ids, repeated ids: every stage keeps what isn't a copy."""
    docs = awkward(spark).select(*c.COLUMNS)
    scored = stored(c.quality(spark, docs, sf), "awkward-quality")
    assert scored.count() == c.quality(spark, docs, sf).count() <= 13
    single = stored(c.near_duplicates(spark, docs, sf), "awkward-single")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    groups = brute_groups([t for _, t in rows])
    want = Counter(min((rows[i][0] is None, rows[i][0] or 0) for i in range(len(rows)) if groups[i] == g)[1] or None for g in set(groups))
    assert Counter(r.doc_id for r in single.collect()) == want
    clean = stored(c.repeated_passages(spark, single, sf), "awkward-clean")
    assert Counter(r.doc_id for r in clean.collect()) == want  # nothing of the rest repeats whole
    packed = c.packed(spark, clean, sf)
    assert Counter(r.doc_id for r in packed.where("piece = 0").collect()) == want
    none = docs.limit(0)
    for stage in (c.quality, c.near_duplicates, c.repeated_passages, c.mixed, c.packed):
        assert stage(spark, none, sf).count() == 0


def test_run_and_names(spark, sf):
    assert len(c.STAGES) == 5 and c.run(spark, sf).count() > 0


def test_near_dedup_judges_rows_without_an_id_by_their_texts(spark, sf):
    rng = random.Random(5)
    text = [words(rng, 80) for _ in range(6)]
    rows = [(None, text[0]), (None, text[1]), (1, text[0]), (2, text[2]), (3, text[1]), (7, text[3]), (7, text[4]), (7, text[4]), (None, text[5]), (None, text[5])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id or 0, r.text) for r in c.near_duplicates(spark, docs, sf).collect()))
    assert got == sorted([(1, text[0]), (3, text[1]), (2, text[2]), (7, text[3]), (7, text[4]), (0, text[5])])


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = stored(c.quality(spark, docs, sf), "q")
    scores = {r.doc_id: r.score for r in queries.op9_compression_quality(spark, sf).collect()}
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, x in scores.items() if x >= 0.5}

    single = stored(c.near_duplicates(spark, kept, sf), "s")
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    assert sorted(r.doc_id for r in single.collect()) == [rows[i][0] for i in sorted(set(brute_groups([t for _, t in rows])))]

    clean = stored(c.repeated_passages(spark, single, sf), "r")
    assert clean.columns == kept.columns and clean.where(F.length("text") != F.col("n_chars")).count() == 0
    left = brute_left([(r.doc_id, r.text.encode()) for r in single.collect()])
    assert {r.doc_id: r.text for r in clean.collect()} == left

    mixed = stored(c.mixed(spark, clean, sf), "m")
    assert {r.doc_id for r in mixed.select("doc_id").collect()} == {r.doc_id for r in clean.select("doc_id").collect()}
    packed = c.packed(spark, mixed, sf)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in mixed.select("doc_id").collect()}
