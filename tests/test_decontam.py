"""Decontamination against plain versions of the rules."""

import random
from difflib import SequenceMatcher

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.operators import decontam
from quarry.operators.blocks import Automaton, Benchmark
from quarry.plans import catalog


def plain_blocks(a, b, least):
    return [tuple(m) for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size >= least]


def test_blocks_against_the_rule():
    rng = random.Random(0)
    for _ in range(3000):
        kinds, least = rng.choice([1, 2, 3, 4, 8, 30]), rng.choice([1, 2, 5])
        a, b = ([rng.randrange(kinds) for _ in range(rng.randint(0, m))] for m in (60, 40))
        for _ in range(rng.randint(0, 3)):
            if a and b:
                i, at = rng.randrange(len(b)), rng.randrange(len(a))
                a[at:at] = b[i : i + rng.randint(1, 15)]
        assert Benchmark(b).blocks(a, least) == plain_blocks(a, b, least)


def test_automaton_is_linear():
    assert len(Automaton([0] * 5000).next) == 5001
    assert len(Automaton([k % 7 for k in range(5000)]).next) <= 10_000
    assert Benchmark(["the"] * 500).ratio(["the"] * 50_000) == 1.0


def test_rolling_grams_are_equal_where_the_tokens_are():
    rng = random.Random(1)
    rows = [[rng.randrange(3) for _ in range(rng.randint(0, 30))] for _ in range(200)]
    for n, last in ((1, True), (3, False), (8, True), (8, False)):
        row, place, held = decontam.rolling(np.array(sum(rows, []), np.uint64), np.array([len(r) for r in rows]), n, last)
        begin = np.cumsum([0] + [len(r) for r in rows])
        want = [(k, tuple(r[i : i + n])) for k, r in enumerate(rows) for i in range(len(r) - n + last)]
        got = [(k, tuple(rows[k][p - begin[k] : p - begin[k] + n])) for k, p in zip(row.tolist(), place.tolist(), strict=True)]
        assert got == want
        named = {}
        for (_, gram), h in zip(got, held.tolist(), strict=True):
            assert named.setdefault(gram, h) == h
        assert len(set(named.values())) == len(named)


def test_the_filter_loses_nothing_and_lets_little_through(spark):
    bench = spark.createDataFrame([("b", k, " ".join(f"w{k}x{i}" for i in range(40))) for k in range(50)], "benchmark string, eval_idx long, text string").repartition(5)
    bloom, many = decontam.gram_filter(bench, last=True)
    assert many == 50 * 33 and len(bloom.value) * 64 == 32768
    own = decontam._grams(bench, [], 8, True, decontam.words).select("h").toArrow().column(0).to_numpy().view(np.uint64)
    assert len(own) == many and decontam.maybe_in(own, bloom.value).all()
    assert decontam.maybe_in(np.random.default_rng(0).integers(0, 1 << 63, 100_000, dtype=np.uint64), bloom.value).mean() < 0.01
    assert decontam.gram_filter(bench.limit(0))[1] == 0


def plain_verify(train, bench, token, threshold=0.5):
    grams = lambda tk: {tuple(tk[i : i + 8]) for i in range(len(tk) - 8)}
    texts, items = [(i, token(t)) for i, t in train if t is not None], [(n, e, token(t)) for n, e, t in bench]
    shared, found = {}, {}
    for name, e, b in items:
        own = grams(b)
        for i, a in texts:
            both = len(own & grams(a))
            if both:
                shared[i, name, e] = both
                if sum(m[2] for m in plain_blocks(a, b, 5)) / len(b) >= threshold:
                    found[name, i] = min(e, found.get((name, i), e))
    return sorted((*k, v) for k, v in shared.items()), sorted((n, i, e) for (n, i), e in found.items())


@pytest.mark.parametrize("kind", ["words", "ids"])
def test_overlap_and_verification_against_all_pairs(spark, sf, kind):
    """Every document of up to 4,000 characters against every benchmark text, pair by pair."""
    train, bench = catalog.train_texts(spark, sf).where("length(text) <= 4000"), catalog.bench_texts(spark, sf)
    if kind == "words":
        token, tokenise = (lambda t: t.lower().split()), decontam.words
    else:
        path = public_tokenizers.path("byte_bpe_50k.json")
        coder = Tokenizer.from_file(path)
        coder.encode_special_tokens = True
        token, tokenise = (lambda t: coder.encode(t, add_special_tokens=False).ids), decontam.subwords(path)
    shared, found = plain_verify([tuple(r) for r in train.collect()], [tuple(r) for r in bench.collect()], token)
    got = decontam.shared_grams(train, bench, tokenise=tokenise)
    assert sorted((r.id, r.benchmark, r.eval_idx, r.grams) for r in got.collect()) == shared and len(shared) >= 3
    for options in ({}, {"most_bytes": 2000}):  # one slice, and several
        assert sorted(map(tuple, decontam.verify(got, train, bench, tokenise=tokenise, **options).collect())) == found
    assert found


def test_many_candidates_of_one_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    train = spark.createDataFrame([(1, text), (1, "other"), (None, text), (2, None)], "id long, text string")
    bench = spark.createDataFrame([("b", k, text if k % 3 else text + " and much more" * 40) for k in range(1500)], "benchmark string, eval_idx long, text string")
    found = decontam.shared_grams(train, bench)
    assert [tuple(r) for r in decontam.verify(found, train, bench).collect()] == [("b", 1, 1)]


def test_candidates_are_found_once(spark):
    train = spark.createDataFrame([(k, "a b c d e f g h i j") for k in range(7)], "id long, text string")
    bench = spark.createDataFrame([("b", 1, "a b c d e f g h i j"), ("b", 2, "k l m n o p q r s t")], "benchmark string, eval_idx long, text string")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    found = decontam.shared_grams(train, bench)
    found = found.mapInArrow(counted, found.schema)
    assert sorted(map(tuple, decontam.verify(found, train, bench, most_bytes=1).collect())) == [("b", k, 1) for k in range(7)]
    assert seen.value == 7


def test_bytes_leave_out_no_text_with_a_shared_gram(spark):
    """Texts of odd characters, with passages that begin within words and characters' bytes; most other texts aren't tokenized."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = decontam.subwords(path)
    assert decontam.token_bytes(path)
    rng = random.Random(5)
    odd = ["a", "é", "ê", "ß", "日本", "\U0001f600", "\n\n", "  ", "\x1c", "\xa0", "<|endoftext|>", "12", "'s", "!?", "the ", " lorem"]
    text = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    bench = [("b", k, text(rng.randint(0, 60), odd)) for k in range(12)]
    train = []
    for k in range(300):
        source, at = rng.choice(bench)[2], rng.randrange(60)
        train.append((k, rng.choice(["", "x", text(9, odd)]) + source[at : at + rng.randint(0, 40)] + rng.choice(["", text(9, odd)])))
    train += [(1000 + k, "".join(chr(rng.randrange(97, 123)) for _ in range(300))) for k in range(500)] + [(2000, ""), (2001, None)]
    t, b = spark.createDataFrame(train, "id long, text string"), spark.createDataFrame(bench, "benchmark string, eval_idx long, text string")
    real = Tokenizer.from_file(path)
    real.encode_special_tokens = True
    for n, last in ((8, False), (9, True), (3, True)):
        grams = lambda s: {tuple(e[i : i + n]) for e in [real.encode(s or "", add_special_tokens=False).ids] for i in range(len(e) - n + last)}  # noqa: E731, B023
        mine = {k: grams(s) for k, s in train}
        want = sorted((k, x, i, len(mine[k] & grams(s))) for k, _ in train for x, i, s in bench if mine[k] & grams(s))
        assert want and sorted(map(tuple, decontam.shared_grams(t, b, n=n, last=last, tokenise=ids).collect())) == want
    kept = {r.id for r in decontam._worth(t, b, 8, False, ids, decontam.gram_filter(b, tokenise=ids)[1]).collect()}
    assert sum(k < 1000 for k in kept) > 100 and not [k for k in kept if k >= 1000]


def test_tokenizers_that_change_texts_have_no_bytes():
    assert decontam.token_bytes(public_tokenizers.path("word_bpe_49k.json")) is None
