"""Run-length index of a few strings, and their matching statistics.

The Burrows-Wheeler transform of the strings is kept as runs of equal
symbols, with the text position of the first and the last row of each run
(the sampled run ends) and the longest common prefix across each run border.
Within a run, the common prefix of a position with its neighbour in suffix order
is one less than at the position before.  So the samples, streamed in text order,
give the matching statistic of every position: the longest match of the
text from there with any other place.  Strings that stand in the collection several times
are kept once with their count, as copies add no runs.

Strings are symbols 1 to 256 (byte + 1) and end with separators, which differ
from each other, so that no match crosses one."""

from __future__ import annotations

import numpy as np

FIRST = 7                     # symbols of 9 bits in the first sort key
_SYMBOL = np.int64(9)


def _shifted(x: np.ndarray, by: int, fill: int = 0) -> np.ndarray:
    out = np.full_like(x, fill)
    if by < len(x):
        out[:len(x) - by] = x[by:]
    return out


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, and for each place of it the first place and the
    size of its group of equal keys."""
    order = np.argsort(key)
    sorted_ = key[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
    size = np.diff(np.append(first, len(key)))
    return order, np.repeat(first, size), np.repeat(size, size)


def suffix_order(text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of symbols (0 separates), and for the prefixes of FIRST,
    2 * FIRST, ... symbols from each position on the first row of those that are equal."""
    n = len(text)
    one = text.astype(np.int64)
    two = (one << _SYMBOL) | _shifted(one, 1)
    four = (two << 2 * _SYMBOL) | _shifted(two, 2)
    three = (two << _SYMBOL) | _shifted(one, 2)
    key = (four << 3 * _SYMBOL) | _shifted(three, 4)
    ends = np.flatnonzero(text == 0)
    short = (ends[:, None] - np.arange(FIRST)).ravel()             # positions within FIRST of their separator
    left = np.tile(np.arange(FIRST), len(ends))
    ok = (short >= 0) & (np.repeat(np.concatenate(([-1], ends[:-1])), FIRST) < short)
    short, left = short[ok], left[ok]
    key[short] &= -1 << (_SYMBOL * (FIRST - left))
    order, first, size = _grouped(key)
    # what a separator ends differs from all else, by its place
    apart = np.zeros(n, bool)
    apart[short] = True
    at = np.flatnonzero(apart[order])
    some = order[at]
    order[at] = some[np.lexsort((some, key[some]))]
    first[at], size[at] = at, 1
    rank = np.empty(n, np.int32)
    rank[order] = first
    levels, length = [rank], FIRST
    active = order[size > 1]                                       # sorted by rank
    while len(active):
        after = active + length
        key = rank[active].astype(np.int64) * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        inner, first, size = _grouped(key)
        group = rank[active]                                       # rows of ``active`` before the sort
        base = group - np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))[
            np.cumsum(np.concatenate(([0], group[1:] != group[:-1])))]
        moved = active[inner]
        order[base + np.arange(len(active))] = moved
        rank = rank.copy()
        rank[moved] = base + first
        levels.append(rank)
        active = moved[size > 1]
        length *= 2
    return order, levels


def _common(text: np.ndarray, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefixes of the suffixes at a[i] and b[i]."""
    n, length = len(text), np.zeros(len(a), np.int64)
    for t in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        ok = (x < n) & (y < n)
        ok[ok] = levels[t][x[ok]] == levels[t][y[ok]]
        length[ok] += FIRST << t
    todo = np.arange(len(a))
    for _ in range(FIRST - 1):
        x, y = a[todo] + length[todo], b[todo] + length[todo]
        ok = (text[x] == text[y]) & (text[x] > 0)
        todo = todo[ok]
        length[todo] += 1
    return length


class RunIndex:
    """``heads`` and ``lengths`` of the runs, ``first`` and ``last`` text
    positions of each, ``common``: the common prefix of ``first[i]`` with ``last[i - 1]``.
    ``counts`` says how often each string stands in the collection; it is indexed once."""

    def __init__(self, strings: list[bytes], counts: list[int] | None = None):
        self.counts = np.asarray(counts if counts is not None else [1] * len(strings))
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes + 1)))
        self.size = int(self.starts[-1])
        text = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.uint16) + np.uint16(1)
        text[self.starts[1:] - 1] = 0
        order, levels = suffix_order(text)
        before = text[order - 1]                    # row of position 0: the last separator
        border = np.ones(self.size, bool)
        border[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        rows = np.flatnonzero(border)
        self.heads, self.lengths = before[rows], np.diff(np.append(rows, self.size))
        self.first, self.last = order[rows], order[np.append(rows[1:], self.size) - 1]
        self.common = np.zeros(len(rows), np.int64)
        self.common[1:] = _common(text, levels, self.first[1:], self.last[:-1])

    def statistics(self) -> np.ndarray:
        """For each position the longest match with another position."""
        reach = np.arange(self.size)
        reach[self.first] += self.common
        after = np.arange(self.size)
        after[self.last[:-1]] += self.common[1:]
        several = np.flatnonzero(self.counts > 1)             # match their copies to the end
        after[self.starts[several]] = self.starts[several + 1] - 1
        return np.maximum.accumulate(np.maximum(reach, after)) - np.arange(self.size)

    def repeated(self, length: int) -> list[np.ndarray]:
        """For each string, which of its windows of ``length`` start elsewhere too."""
        long = self.statistics() >= length
        return [long[a:max(a, b - length)] for a, b in zip(self.starts[:-1], self.starts[1:])]
