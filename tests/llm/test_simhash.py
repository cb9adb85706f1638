import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from quarry.llm import simhash as s
from tests.llm.fixtures import awkward, empty


def brute_print(text: str, k: int = 3) -> int:
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    if not w:
        return 0
    found = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    bits = [0] * 64
    for f in found:
        h = xxhash.xxh64(f, seed=42).intdigest()
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(found))


def brute_components(ids, prints, radius=3):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", ["", " ", "One", "a B", "x y z", "Éa ÉA É\x0bq r", "w " * 50])
def test_fingerprint(text):
    assert s.fingerprint(text.encode()) == brute_print(text)


def test_gray_rank_orders_codes():
    codes = np.arange(64, dtype=np.uint64)
    walk = codes[np.argsort(s.gray_rank(codes))]
    assert all(bin(int(a ^ b)).count("1") == 1 for a, b in zip(walk, walk[1:]))


def near_codes(n=12, each=25):
    rng = np.random.default_rng(4)
    out = []
    for base in rng.integers(0, 1 << 63, n, dtype=np.uint64):
        for _ in range(each):
            x = int(base)
            for b in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(b)
            out.append(x)
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("bucket", [20_000, 60])
def test_components_over_tasks(spark, bucket):
    codes = near_codes()
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame(list(enumerate(signed)), "id long, fp long")
    got = {r.id: r.component for r in s.components(s.links(df, bucket_rows=bucket)).collect()}
    want = brute_components(range(len(codes)), dict(enumerate(codes)))
    assert {i: got.get(i, i) for i in want} == want


def test_query_equals_brute_force(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(40):
        base = [rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(rng.randint(0, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 2)):
            if base:
                base[rng.randrange(len(base))] = "zz"
            texts.append(" ".join(base))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.f, r.component_id) for r in s.near_duplicates(df).select("doc_id", s.hex64("fp").alias("f"), "component_id").collect()}
    prints = {i: brute_print(t) for i, t in enumerate(texts)}
    want = brute_components(range(len(texts)), prints)
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


def test_awkward_rows(spark):
    rows = [(r.doc_id, r.text or "") for r in awkward(spark).collect()]
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in s.near_duplicates(awkward(spark)).collect())
    assert got == brute_rows(rows)
    assert s.near_duplicates(empty(spark)).count() == 0


def brute_rows(rows):
    """(id, print, component) of each row: rows are linked by their prints or by their ids."""
    prints, group = [brute_print(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 3 or (rows[a][0] is not None and rows[a][0] == rows[b][0]):
                low, up = sorted((group[a], group[b]))
                group = [low if g == up else g for g in group]
    name = {g: min((i for (i, _), h in zip(rows, group) if g == h and i is not None), default=None) for g in group}
    return Counter((i, p, name[g]) for (i, _), p, g in zip(rows, prints, group))


def test_ids_that_repeat_join_their_links(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join(rng.choice("abcdefghij") * 3 for _ in range(80)) for _ in range(4))
    rows = [(5, a), (5, b), (1, a), (7, b), (None, b), (None, c), (None, c), (9, d), (9, d), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = s.near_duplicates(df).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {5: 1, 1: 1, 7: 1, 9: 9}
    assert Counter(r.component_id for r in got if r.doc_id is None) == {1: 1, None: 3}
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == brute_rows([(i, t or "") for i, t in rows])
