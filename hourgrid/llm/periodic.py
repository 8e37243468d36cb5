"""Periodic runs of words, by extensions over a difference cover and a harmonic grid.

A run is a maximal stretch of words with smallest period ``q`` and at least ``REPEATS`` periods long. For a period ``p``, every run
covers several neighbouring points of the grid 0, p, 2p, ...: where the words from a grid point on and those from the
next grid point on agree for long enough, the run's end is their longest common extension, and its beginning
the same backwards. The grids of all periods have n (1 + 1/2 + 1/3 + ...) points together.

The longest common extension of two suffixes is answered from the sorted suffixes at the positions of a difference
cover only. For any two positions some small shift takes both into the cover: the words before it are compared one by one, and
from there on the least common prefix between the two in sorted order, by a sparse table, is the answer. Most grid
points disagree within the few words before, so that for most texts nothing is sorted at all.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Fixed value: residues whose differences give every residue modulo ``MODULUS``.
COVER, MODULUS = (0, 1, 3, 9), 13
#: Least number of periods of a run, and its least length.
REPEATS, LEAST = 4, 6
#: Grid points looked at together.
TOGETHER = 1 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

_IN_COVER = np.zeros(MODULUS, bool)
_IN_COVER[list(COVER)] = True
#: _SHIFT[a, b]: the least shift that takes residues a and b into the cover together.
_SHIFT = np.array([[next(s for s in range(MODULUS) if _IN_COVER[(a + s) % MODULUS] and _IN_COVER[(b + s) % MODULUS])
                    for b in range(MODULUS)] for a in range(MODULUS)])


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of numbers."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


class Extensions:
    """Longest common extensions of the suffixes of a sequence of numbers from 1 on."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        # the end is a word of its own, less than all others, and nothing follows it
        self.words = np.concatenate((words.astype(np.int64), np.zeros(2 * MODULUS + 1, np.int64)))
        self._sorted = False

    def _sort(self) -> None:
        """Ranks of the cover's suffixes, and the sparse table over their common prefixes."""
        places = [np.arange(c, self.n + 1, MODULUS) for c in COVER]
        at = np.concatenate(places)
        self.number = np.full(self.n + 1 + MODULUS, -1, np.int64)
        self.number[at] = np.arange(len(at))
        # blocks of MODULUS words; the last of each residue holds the end, so none goes on into another residue
        rank = _ranks(self.words[at])
        for k in range(1, MODULUS):
            rank = _ranks(rank * (int(self.words.max()) + 1) + self.words[at + k])
        # doubling: the ranks of 1, 2, 4, ... blocks, until all differ
        blocks, levels = len(at), [rank]
        reach = 1
        while int(rank.max()) + 1 < blocks:
            later = at + reach * MODULUS
            follows = np.where(later <= self.n, self.number[np.minimum(later, self.n)], -1)
            second = np.where((later <= self.n) & (follows >= 0), rank[follows] + 1, 0)
            rank = _ranks(rank * (blocks + 1) + second)
            levels.append(rank)
            reach *= 2
        self.rank = rank
        order = np.empty(blocks, np.int64)
        order[rank] = np.arange(blocks)
        self.levels_table = self._table(self._neighbours(at[order[:-1]], at[order[1:]], levels))
        self._sorted = True

    def _neighbours(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes, in words, of suffixes that are next to each other in order."""
        a, b, size = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            step = MODULUS << k
            inside = np.flatnonzero((a <= self.n) & (b <= self.n))
            same = inside[levels[k][self.number[a[inside]]] == levels[k][self.number[b[inside]]]]
            a[same] += step
            b[same] += step
            size[same] += step
        return size + self._few(a, b, np.full(len(a), MODULUS))

    def _few(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words agree from ``a`` and ``b`` on, up to ``most`` each."""
        size, on = np.zeros(len(a), np.int64), np.arange(len(a))
        for k in range(int(most.max(initial=0))):
            on = on[most[on] > k]
            on = on[(np.maximum(a[on], b[on]) + k < self.n)]
            on = on[self.words[a[on] + k] == self.words[b[on] + k]]
            if not len(on):
                break
            size[on] += 1
        return size

    @staticmethod
    def _table(row: np.ndarray) -> list[np.ndarray]:
        table, width = [row], 1
        while 2 * width <= len(row):
            last = table[-1]
            table.append(np.minimum(last[:-width], last[width:]))
            width *= 2
        return table

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least common prefix between two ranks, low < high."""
        out = np.empty(len(low), np.int64)
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level):
            on = np.flatnonzero(level == k)
            row = self.levels_table[k]
            out[on] = np.minimum(row[low[on]], row[high[on] - (1 << k)])
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of each pair of different positions up to n."""
        shift = _SHIFT[a % MODULUS, b % MODULUS]
        if not self._sorted:  # MODULUS words on lies the cover too: most pairs differ before, and nothing has to be sorted
            shift = shift + MODULUS
        size = self._few(a, b, shift)
        more = np.flatnonzero((size == shift) & (np.maximum(a, b) + shift <= self.n))
        if len(more):
            if not self._sorted:
                self._sort()
            x, y = (self.rank[self.number[c[more] + shift[more]]] for c in (a, b))
            size[more] += self._least(np.minimum(x, y), np.maximum(x, y))
        return size


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbers from 1 on, by start, then period."""
    n, top = len(words), len(words) // REPEATS
    if n < LEAST:
        return []
    ahead, back = Extensions(words), None
    found: dict[tuple[int, int], int] = {}
    per_period = -(-n // np.arange(1, top + 1)) if top else np.empty(0, np.int64)
    ends = np.cumsum(per_period)
    first = 0
    while first < top:  # the periods first + 1 to last
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + TOGETHER, "right")))
        p = np.repeat(np.arange(first + 1, last + 1), per_period[first:last])
        began = ends[first:last] - per_period[first:last]
        at = (np.arange(len(p)) - np.repeat(began - began[0], per_period[first:last])) * p
        first = last
        # the first grid point of a run is followed by more than two periods of it
        on = np.flatnonzero((at + p < n) & (at + 3 * p <= n))
        on = on[words[at[on]] == words[at[on] + p[on]]]
        at, p = at[on], p[on]
        if not len(at):
            continue
        size = ahead.common(at, at + p)
        on = np.flatnonzero(size >= (REPEATS - 2) * p)
        at, p, size = at[on], p[on], size[on]
        if not len(at):
            continue
        # the extension backwards ends where the word before the run differs; one that reaches the grid point before is that point's
        if back is None:
            back = Extensions(words[::-1])
        left = back.common(n - at, n - at - p)
        start, length = at - left, left + p + size
        on = np.flatnonzero((left < p) & (length >= np.maximum(LEAST, REPEATS * p)))
        for s, m, q in zip(start[on].tolist(), length[on].tolist(), p[on].tolist(), strict=True):
            # the same stretch is also periodic in multiples of its smallest period, which come later
            found.setdefault((s, m), q)
    return sorted((s, m, q) for (s, m), q in found.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for s, m, q in runs:
        change[s + q] += 1
        change[s + m] -= 1
    return np.cumsum(change[:-1]) == 0


def numbered(words: list[str]) -> np.ndarray:
    """Words as numbers from 1 on, equal words alike."""
    number: dict[str, int] = {}
    return np.fromiter((number.setdefault(w, len(number) + 1) for w in words), np.int64, len(words))


Rewrite = Callable[[int | None, list[str]], list[str]]


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, runs (start, length, period), collapsed.

    Words are cut at blanks, tabs and line ends. ``collapsed`` is the text without the repetitions: the words that no run holds
    after its first period, joined by one blank. Null and empty texts, and those without a word, have no run and
    collapse to the empty text. Null and repeated ids are kept: each row is looked at by itself. ``rewrite`` changes the words of
    a document before. Other columns are ignored.
    """
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                sizes, runs, collapsed = [], [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    words = WORD.findall(text.as_py() or "")
                    if rewrite:
                        words = rewrite(doc_id, words)
                    found = find_runs(numbered(words))
                    sizes.append(len(words))
                    runs.append(found)
                    collapsed.append(" ".join([words[i] for i in np.flatnonzero(kept_words(len(words), found))] if found else words))
                cells = np.array(list(chain.from_iterable(runs)), np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(cells[:, i]) for i in range(3)], ["start", "length", "period"])
                offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, structs).cast(run_type), pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the most periods, by exact fractions; ties to the least start, then the least period."""

    def better(a: Column, b: Column) -> Column:
        more, other = a["length"] * b["period"], b["length"] * a["period"]
        return (more > other) | ((more == other) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))))

    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(better(r, best), r).otherwise(best))
