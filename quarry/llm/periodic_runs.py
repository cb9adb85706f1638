"""Periodic runs of words: the same few words over and over, by Main-Lorentz divide and conquer.

A run is a stretch of consecutive words of smallest period q (words q apart are identical) that no
neighbouring word extends, of at least ``min_words`` words and ``exponent`` periods.  A text's words are interned to
numbers.  The sequence is halved; of a run that crosses the middle at least one whole period lies on one side
of it, so for each period the Z-functions of the halves at the middle, forwards and backwards, say how far it
goes to both sides.  The halves are searched in turn.  A piece that its node's border cuts, which the next word shows, is left to
the node that holds it whole; equal intervals become one, with their smallest period.

Only parts of a text are searched that can hold a run: each of a run's words occurs at least ``exponent`` times in it, so a word
that is rarer in its stretch splits the stretch, and stretches of fewer than ``min_words`` words leave.  Prose falls apart so; what repeats is left.
The time is n log n for n words left, whatever they are, and a text is read by one task, with a few numbers a word in memory.

Defined results: a null text has no words and collapses to an empty text; an empty or blank one likewise; equal rows get equal results;
an empty table gives an empty result; keys may be null or repeat; columns named as the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import in_arrow

NEW = ["n_words", "runs", "collapsed"]
RUNS = "array<struct<start:long,length:long,period:long>>"
CHUNK = 4 << 20  # bytes of collapsed text a batch
TURNS = 8


def z_function(s: list[int]) -> list[int]:
    """How many items from each place equal those from the beginning; the last item occurs once."""
    z, first, left, right = [0] * len(s), s[0], 0, 0
    for i in range(1, len(s)):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        elif s[i] != first:
            continue
        while s[k] == s[i + k]:
            k += 1
        z[i], left, right = k, i, i + k
    return z


def _stretches(ids: np.ndarray, min_words: int, times: int) -> list[tuple[int, int]]:
    """Stretches outside which no run has a word: a word that isn't in its stretch ``times`` times splits it.

    Turns only prune, so their number doesn't change what is found.
    """
    at, of = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    for _ in range(TURNS):
        _, word, many = np.unique(of * (int(ids.max()) + 1) + ids[at], return_inverse=True, return_counts=True)
        often = many[word] >= times
        whole = bool(often.all())
        at, of = at[often], of[often]
        cut = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(of) != 0)))[: len(at)]
        of = np.cumsum(cut) - 1
        long = np.bincount(of, minlength=1)[of] >= min_words if len(at) else np.zeros(0, bool)
        whole = whole and bool(long.all())
        at, of = at[long], of[long]
        if whole or not len(at):
            break
    first = np.flatnonzero(np.concatenate(([True], np.diff(of) != 0)))[: len(at)]
    return [(int(at[a]), int(at[b - 1]) + 1) for a, b in zip(first, np.append(first[1:], len(at)), strict=True)] if len(at) else []


def _crossing(ids: list[int], low: int, high: int, min_words: int, exponent: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of the repetitions over the middle of ids[low:high], within it."""
    mid = (low + high) // 2
    left, right = ids[low:mid], ids[mid:high]
    # ahead[x - low]: words from x on that equal those from mid on; behind[x - low]: words before x that equal those before mid.
    ahead = np.array(z_function([*right, -1, *left, *right, -2])[len(right) + 1 :])
    left.reverse()
    right.reverse()
    behind = np.array(z_function([*left, -1, *right, *left, -2])[len(left) + 1 :])[::-1]
    most = (high - low) // exponent
    period = np.arange(1, min(most, high - mid) + 1)  # the period from mid on
    yield from _long(mid - behind[mid + period - low], mid + period + ahead[mid + period - low], period, min_words, exponent)
    period = np.arange(1, min(most, mid - low) + 1)  # the period before mid
    yield from _long(mid - period - behind[mid - period - low], mid + ahead[mid - period - low], period, min_words, exponent)


def _long(start: np.ndarray, end: np.ndarray, period: np.ndarray, min_words: int, exponent: int) -> Iterator[tuple[int, int, int]]:
    keep = end - start >= np.maximum(min_words, exponent * period)
    return zip(start[keep].tolist(), end[keep].tolist(), period[keep].tolist(), strict=True)


def runs_of(words: list[bytes], min_words: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    if len(words) < min_words:
        return []
    codes: dict[bytes, int] = {}
    numbers = [codes.setdefault(w, len(codes)) for w in words]
    found: dict[tuple[int, int], int] = {}
    for begin, stop in _stretches(np.array(numbers), min_words, exponent):
        ids, waiting = numbers[begin:stop], [(0, stop - begin)]
        while waiting:
            low, high = waiting.pop()
            if high - low < min_words:
                continue
            for start, end, period in _crossing(ids, low, high, min_words, exponent):
                cut = (start == low and low > 0 and ids[low - 1] == ids[low - 1 + period]) or (end == high and high < len(ids) and ids[high] == ids[high - period])
                if not cut:
                    key = (start + begin, end + begin)
                    found[key] = min(period, found.get(key, period))
            mid = (low + high) // 2
            waiting += [(low, mid), (mid, high)]
    return sorted((start, end - start, period) for (start, end), period in found.items())


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by single blanks."""
    if not runs:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(step)[:-1] == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def periodic_runs(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, min_words: int = 24, exponent: int = 3) -> DataFrame:
    """The columns ``keep`` (default: all), then n_words, the runs and the collapsed text."""
    if exponent < 2 or min_words < 1:
        raise ValueError("runs of at least two periods and one word are looked for")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in NEW]
    row = F.struct(*[F.col(c) for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    rows = docs.select(row.alias("row"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, first, size = [], 0, 0
            for k, cell in enumerate(b.column(1)):
                words = cell.as_py().split()  # bytes: at 0x20 and 0x09 to 0x0D only
                found = runs_of(words, min_words, exponent)
                rest = collapsed(words, found)
                out.append((len(words), [dict(zip(("start", "length", "period"), r, strict=True)) for r in found], rest))
                size += len(rest)
                if size >= CHUNK or k == b.num_rows - 1:
                    n, runs, texts = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(out)), pa.array(n, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.binary())], ["row", *NEW])
                    out, first, size = [], k + 1, 0

    schema = rows.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(RUNS).alias("runs"), F.lit(b"").alias("collapsed")).schema
    done = in_arrow(rows, run, schema)
    return done.select(*[F.col("row")[c].alias(c) for c in keep], "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def strongest(runs: str = "runs"):
    """The run of the greatest length / period (ties: smallest start, then period), or null."""
    return F.expr(
        f"""reduce({runs}, cast(null as struct<start:long,length:long,period:long>), (best, r) -> CASE
            WHEN best IS NULL OR r.length * best.period > best.length * r.period THEN r
            WHEN r.length * best.period = best.length * r.period AND (r.start < best.start OR (r.start = best.start AND r.period < best.period)) THEN r
            ELSE best END)"""
    )
