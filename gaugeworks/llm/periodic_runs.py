"""Periodic runs of words, by maximal pairs in the LCP-interval tree of each text.

A pair of places i < j is maximal if the texts that begin there agree for exactly l words and the words before them differ.
It spans a stretch of l + (j - i) words with period j - i that no neighbour extends. So the maximal pairs whose
distance is at most a share of their length are the runs, and nothing has to be extended. The pairs of a run at multiples of
its smallest period span the same stretch: the least distance of a stretch is its period.

Steps, over arrays for many texts at once (a slice of ``SLICE_WORDS`` words):

1. Words become numbers of their own per text, so nothing agrees across texts. Prefix doubling ranks the stretches of five words;
   a run needs two equal ones, and all places whose stretch occurs once leave here. The others are sorted on by doubling; the
   ranks of each step also give the common lengths of neighbours in the order.
2. The intervals of equal prefixes are built bottom up with a stack. An interval keeps its places in order and, per
   word to the left, the list of places that follow this word. Of two intervals that join, each place of the smaller one looks for
   places of the larger one within reach, which is a third of the common length. Such places are occurrences of a
   periodic stretch, each a whole number of periods after the first, so to the right they all have one left word, and
   to the left only the first can have another word than those after it: a place takes the list of one left word, or one place.

Every place joins a larger interval at most log n times, and a pair is made only if it is a run or a multiple of its period,
so the work is n log n with n words, whatever repeats.

Defined cases: null, empty and short texts have no run; a text collapses to its kept words with one blank between them.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeworks.llm.text import map_texts, words_of

#: A run has at least this many words and repetitions of its period.
LEAST_WORDS, LEAST_POWER = 6, 4
SLICE_WORDS = 1 << 18
_SEED = 5
_OUT = "runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of whole numbers."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _shifted(r: np.ndarray, h: int) -> np.ndarray:
    """Ranks ``h`` places on, shifted up by one; 0 beyond the end."""
    out = np.zeros(len(r), np.int64)
    out[:len(r) - h] = r[h:] + 1
    return out


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers, different ones in different texts, each text closed by a number of its own; where texts start."""
    parts, starts, base = [], [], 0
    for words in texts:
        seen: defaultdict[bytes, int] = defaultdict(count(base + 1).__next__)
        starts.append(base)
        parts.append(np.fromiter(map(seen.__getitem__, words), np.int64, len(words)))
        parts.append(np.array([base], np.int64))
        base += len(words) + 1
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array(starts, np.int64)


def sorted_places(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose five words occur more than once, in the order of what follows them, and the words that each has in
    common with the one before it (0 at the first of a group)."""
    n = len(words)
    if n <= _SEED:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = _ranks(words * (int(words.max()) + 2) + _shifted(words, 1))
    if int(pair.max()) + 1 == n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    four = _ranks(pair * (n + 2) + _shifted(pair, 2))
    rank = _ranks(four * (int(words.max()) + 2) + _shifted(words, 4))
    # A group is known by the number of places before it, which stays as groups split.
    sizes = np.bincount(rank)
    rank = (np.cumsum(sizes) - sizes)[rank]
    levels, h = [(_SEED, rank)], _SEED
    open_ = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    live = open_
    while len(live):
        ahead = live + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.lexsort((second, rank[live]))
        at, a, b = live[order], rank[live][order], second[order]
        new_a = np.concatenate([[True], a[1:] != a[:-1]])
        new = new_a | np.concatenate([[True], b[1:] != b[:-1]])
        k = np.arange(len(at))
        first = np.maximum.accumulate(np.where(new_a, k, 0))
        part = np.maximum.accumulate(np.where(new, k, 0))
        rank = rank.copy()
        rank[at] = a + part - first
        h *= 2
        levels.append((h, rank))
        size = np.diff(np.append(np.flatnonzero(new), len(at)))
        live = at[np.repeat(size > 1, size)]
    places = open_[np.argsort(rank[open_])]
    x, y = places[:-1].copy(), places[1:].copy()
    common = np.zeros(len(x), np.int64)
    for h, r in reversed(levels):
        inside = (x < n) & (y < n)
        same = inside & (r[np.minimum(x, n - 1)] == r[np.minimum(y, n - 1)])
        x, y, common = x + h * same, y + h * same, common + h * same
    same = common > 0
    for _ in range(_SEED - 1):
        same = same & (x < n) & (y < n)
        same &= words[np.minimum(x, n - 1)] == words[np.minimum(y, n - 1)]
        x, y, common = x + same, y + same, common + same
    return places, np.concatenate([[0], common]) if len(places) else places


class _Interval:
    """Places with a common prefix: all in order, and by the word to their left. ``shared`` is what its first place in the
    sorted order has in common with the place before it."""

    __slots__ = ("shared", "places", "by_left")

    def __init__(self, shared: int, place: int, left: int):
        self.shared, self.places, self.by_left = shared, [place], {left: [place]}


def _join(first: _Interval, second: _Interval, left: list[int], found: dict[tuple[int, int], int]) -> _Interval:
    """Two neighbours, which share ``second.shared`` words, as one; the runs among the maximal pairs between them are noted as
    ``(start, end): period``."""
    length, shared = second.shared, first.shared
    big, small = (first, second) if len(first.places) >= len(second.places) else (second, first)
    reach = length // (LEAST_POWER - 1)
    places, by_left = big.places, big.by_left
    for i in small.places:
        lo, mid, hi = bisect_left(places, i - reach), bisect_left(places, i), bisect_right(places, i + reach)
        pairs = []
        if mid < hi and left[places[mid]] != left[i]:
            others = by_left[left[places[mid]]]
            pairs = [(i, j) for j in others[bisect_left(others, i):bisect_right(others, i + reach)]]
        if lo < mid and left[places[lo]] != left[i]:
            pairs.append((places[lo], i))
        for a, b in pairs:
            if length + b - a >= LEAST_WORDS:
                at = (a, b + length)
                found[at] = min(found.get(at, b - a), b - a)
    for i in small.places:
        insort(places, i)
        insort(by_left.setdefault(left[i], []), i)
    big.shared = shared
    return big


def maximal_pairs(places: list[int], common: list[int], left: list[int]) -> dict[tuple[int, int], int]:
    """``(start, end): period`` of all runs, from sorted places and the words each shares with the one before it."""
    found: dict[tuple[int, int], int] = {}
    stack: list[_Interval] = []
    for place, shared in zip([*places, -1], [*common, 0]):
        while stack and stack[-1].shared > shared:
            top = stack.pop()
            stack.append(_join(stack.pop(), top, left, found))
        if not shared:
            stack.clear()
        stack.append(_Interval(shared, place, left[place]))
    return found


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of the runs of each text, in order of start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    numbers, starts = word_numbers(texts)
    places, common = sorted_places(numbers)
    if len(places):
        found = maximal_pairs(places.tolist(), common.tolist(), np.roll(numbers, 1).tolist())
        for (start, end), period in found.items():
            k = int(np.searchsorted(starts, start, side="right")) - 1
            out[k].append((start - int(starts[k]), end - start, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by blanks: of each run the first period stays."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [words[k] for k in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def _portions(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    """The words of texts, in portions of about ``SLICE_WORDS`` words; a longer text is a portion of its own."""
    part, held = [], 0
    for raw in texts:
        words = words_of(raw)
        if part and held + len(words) > SLICE_WORDS:
            yield part
            part, held = [], 0
        part.append(words)
        held += len(words)
    if part:
        yield part


def _columns(texts: list[bytes | None]) -> list[pa.Array]:
    sizes, flat, short = [0], [], []
    for part in _portions(texts):
        for words, runs in zip(part, runs_of(part)):
            flat += runs
            sizes.append(len(flat))
            short.append(collapsed(words, runs))
    table = np.array(flat, np.int64).reshape(-1, 3)
    rows = pa.StructArray.from_arrays([pa.array(table[:, k]) for k in range(3)], ["start", "length", "period"])
    return [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), rows), pa.array(short, pa.binary()).cast(pa.string())]


def with_runs(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df[keep]`` with ``runs``, all runs of every whole text in order of start and period, and ``collapsed``, the text
    without their repetitions."""
    return map_texts(df, text, _OUT, _columns, keep)
