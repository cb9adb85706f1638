import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import packing as p
from tests.llm.fixtures import awkward, empty

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def wanted(text: str) -> list[int]:
    return PLAIN.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", "  ", "Don't we'll x's 12a34 É'é İx ſ áb 'S ... a.b,c", "<|endoftext|>", "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|EndOfText|>x", "<|endoftext|", "x<|endoftext|>'s <|endoftext|>.", "é<|startoftext|>\u0301", "<|<|endoftext|>|>", "\x1c a\x85b c\u00a0d", "ß Éa straße", "日本語 text", "a_b _ __c a1", "ﬁ Ǆ", "word, word. (word)"])
def test_parts_give_the_tokenizers_ids(text):
    assert np.frombuffer(p.coder(PATH).encode(text.encode()), "<u4").tolist() == wanted(text)


def test_random_texts_have_the_tokenizers_ids():
    rng = random.Random(9)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "end", "OF", "text", " ", "\n", "'s", "é", "e\u0301", "\u0301", "12", ".", ",", "word", "Ähre", "日本", "\u00a0", "\u200b", "ﬁ"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(p.coder(PATH).encode(text.encode()), "<u4").tolist() == wanted(text), text


def check(plan: p.Plan, counts: Counter) -> int:
    fill, used = defaultdict(list), Counter()
    for n, first, many, sequence, offset in plan.rows:
        assert first == used[n]
        used[n] += many
        for i in range(many):
            fill[sequence + i].append((offset, n))
    assert used == counts and len(fill) == plan.sequences
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= plan.max_len
    return len(fill)


def test_plan_is_close_to_the_bound():
    rng = random.Random(0)
    lengths = [min(4096, max(1, int(rng.lognormvariate(6.3, 1.1)))) for _ in range(4000)]
    counts = Counter(lengths)
    plan = p.Plan(dict(counts))
    assert check(plan, counts) <= 1.01 * math.ceil(sum(lengths) / 4096)
    assert plan.by_pattern > 0.3 * plan.sequences


@pytest.mark.parametrize("lengths", [[], [1], [4096] * 3, [4095, 1, 1], [2049] * 5, [1000] * 17, [4000] * 4 + [97] * 3])
def test_small_plans(lengths):
    check(p.Plan(dict(Counter(lengths))), Counter(lengths))


def test_nnls():
    a, x = np.array([[1.0, 0, 1], [0, 1, 1]]), np.array([2.0, 0, 3])
    got = p.nnls(a, a @ x)
    assert (got >= 0).all() and np.allclose(a @ got, a @ x)


def test_pieces_lie_gapless(spark):
    df = awkward(spark)
    got = p.pack_documents(df, PATH, max_len=256).collect()
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
    want = Counter()  # repeated rows count
    for row in df.collect():
        ids = np.array([*wanted(row.text or ""), 1], "<u4").tobytes()
        want.update((row.doc_id, k, k * 256, len(ids[k * 1024 : k * 1024 + 1024]) // 4, zlib.crc32(ids[k * 1024 : k * 1024 + 1024])) for k in range(math.ceil(len(ids) / 1024)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert p.pack_documents(empty(spark), PATH).count() == 0


def fewest(lengths: list[int], most: int) -> int:
    """The least number of sequences, by trying all ways."""
    best = len(lengths)

    def place(k: int, room: tuple[int, ...]) -> None:
        nonlocal best
        if len(room) >= best:
            return
        if k == len(lengths):
            best = len(room)
            return
        for i in {r: i for i, r in enumerate(room) if r >= lengths[k]}.values():
            place(k + 1, tuple(sorted((*room[:i], room[i] - lengths[k], *room[i + 1 :]))))
        place(k + 1, (*room, most - lengths[k]))

    place(0, ())
    return best


def test_small_histograms_against_the_optimum():
    rng = random.Random(8)
    off = 0
    for _ in range(200):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        plan = p.Plan(dict(Counter(lengths)), max_len=20)
        check(plan, Counter(lengths))
        least = fewest(lengths, 20)
        assert plan.sequences <= least + 1
        off += plan.sequences - least
    assert off <= 6


@pytest.mark.parametrize("counts, sequences", [({1366: 1000, 1365: 2000}, 1000), ({3000: 1000, 1000: 1000, 96: 1000}, 1000), ({2049: 100, 2047: 100}, 100), ({4096: 7}, 7), ({}, 0)])
def test_patterns_that_fit_exactly(counts, sequences):
    plan = p.Plan(counts)
    check(plan, Counter(counts))
    assert plan.sequences == plan.by_pattern == sequences


@pytest.mark.parametrize("mean, spread", [(5.0, 0.5), (5.0, 1.0), (6.5, 1.0)])
def test_patterns_fill_short_and_long_documents(mean, spread):
    lengths = np.clip(np.random.default_rng(0).lognormal(mean, spread, 100_000).astype(int), 1, 4096)
    counts = Counter(lengths.tolist())
    plan, plain = p.Plan(dict(counts)), p.Plan(dict(counts), share=0.0)
    check(plan, counts)
    assert plan.by_pattern > plan.sequences / 2
    assert plan.sequences <= 1.002 * plain.sequences + 1 and plan.sequences <= 1.01 * lengths.sum() / 4096 + 1


def test_memory_of_parts_is_bounded():
    coder = p.WordCoder(public_tokenizers.path("word_bpe_49k.json"))
    for k in range(3000):
        coder.encode(f"word{k} {'x' * 500}{k}".encode())
    assert not any(len(part) > p.LONGEST for part in coder)
    coder.held = coder.most
    first = coder.encode(b"wordfresh word1")
    assert len(coder) <= 4 and coder.older and coder.encode(b"wordfresh word1") == first
