"""Matching blocks of two token sequences by a suffix automaton.

The rule: take the longest block of equal tokens (of several the one that starts first in the first sequence, then the one that starts
first in the second), then do the same to the left and to the right of it in both sequences.  Blocks shorter
than ``least`` don't count, and nothing inside a part whose longest block is shorter can count either.
"""

from __future__ import annotations

from collections.abc import Hashable, Sequence

import numpy as np


class Automaton:
    """All substrings of a sequence of numbers: a token's walk gives the longest match that ends with it."""

    def __init__(self, items: Sequence[int]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [0]  # first: where the state's strings first end
        last = 0
        for at, x in enumerate(items):
            new = self._state(dict(), 0, self.length[last] + 1, at + 1)
            p = last
            while p >= 0 and x not in self.next[p]:
                self.next[p][x] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][x]
                if self.length[q] == self.length[p] + 1:
                    self.link[new] = q
                else:
                    copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
                    while p >= 0 and self.next[p].get(x) == q:
                        self.next[p][x] = copy
                        p = self.link[p]
                    self.link[q] = self.link[new] = copy
            last = new

    def _state(self, following: dict[int, int], link: int, length: int, first: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def matches(self, items: Sequence[int]) -> tuple[list[int], list[int]]:
        """For each place of ``items`` the length of the longest match that ends there, and where that first ends in the sequence."""
        lengths, ends, state, have = [], [], 0, 0
        for x in items:
            while state and x not in self.next[state]:
                state = self.link[state]
                have = self.length[state]
            if x in self.next[state]:
                state, have = self.next[state][x], have + 1
            lengths.append(have)
            ends.append(self.first[state])
        return lengths, ends


class Benchmark:
    """A benchmark's tokens, ready to be compared to many texts."""

    def __init__(self, tokens: Sequence[Hashable]):
        self.codes: dict[Hashable, int] = {}
        self.items = [self.codes.setdefault(t, len(self.codes)) for t in tokens]
        self.automaton = Automaton(self.items)

    def blocks(self, tokens: Sequence[Hashable], least: int = 5) -> list[tuple[int, int, int]]:
        """(start in ``tokens``, start here, length) of the matching blocks of at least ``least`` tokens, in order.

        The first walk reads all tokens once; later ones only those that some match of ``least`` tokens covers.
        """
        items = [self.codes.get(t, -1) for t in tokens]
        out: list[tuple[int, int, int]] = []
        lengths, ends = self.automaton.matches(items)
        covered = np.zeros(len(items) + 1, np.int64)
        far = np.array(lengths, np.int64)
        stop = np.flatnonzero(far >= least)
        np.add.at(covered, stop - far[stop] + 1, 1)
        np.add.at(covered, stop + 1, -1)
        open_ = np.cumsum(covered)[: len(items)] > 0
        place = np.flatnonzero(open_)  # what no match covers can't be in a block; it still parts the blocks
        walk: list[int] = []
        where: list[int] = []
        for k, at in enumerate(place.tolist()):
            if k and place[k - 1] != at - 1:
                walk.append(-1)
                where.append(-1)
            walk.append(items[at])
            where.append(at)
        waiting = [(0, len(walk), 0, len(self.items))]
        while waiting:
            alo, ahi, blo, bhi = waiting.pop()
            if ahi - alo < least or bhi - blo < least:
                continue
            held = self.automaton if (blo, bhi) == (0, len(self.items)) else Automaton(self.items[blo:bhi])
            lengths, ends = held.matches(walk[alo:ahi])
            size = max(lengths)
            if size < least:
                continue
            k = lengths.index(size)
            a, b = alo + k + 1 - size, blo + ends[k] - size
            out.append((where[a], b, size))
            waiting += [(alo, a, blo, b), (a + size, ahi, b + size, bhi)]
        return sorted(out)

    def ratio(self, tokens: Sequence[Hashable], least: int = 5) -> float:
        """Tokens in the blocks as a share of the benchmark's tokens."""
        return sum(size for _, _, size in self.blocks(tokens, least)) / len(self.items) if self.items else 0.0
