"""Periodic runs of words: maximal stretches whose smallest period fits in ``REPEATS`` times or more.

Phase one of Baier's suffix sorter groups positions by the longest Lyndon word that starts there: groups are refined
from the highest to the lowest, each member's nearest lower position to the left takes over the member's word, and
positions that took over the same number of words move to a new group just above their old one. The lengths left at
the end are the Lyndon array. It is run under the order of the symbols and under the reversed order. Every run has
a Lyndon root under one of them, so each Lyndon word is extended by its longest common extensions in both directions
and kept if the result is long enough.

Common extensions compare ranks of blocks of 1, 2, 4... words, so they are exact. Before the sorter, stretches that
cannot hold a run are left out, exactly: with three repeats or more, each gram of ``MIN_WORDS`` * (1 - 2 / REPEATS) words
within a run occurs twice in it, so a run lies in a stretch of repeated grams, as do the words it could be extended by.
(Grams are told apart by a 64-bit hash; equal hashes of different grams only make a stretch longer.)

Defined results: a null, empty or blank text has no words and no runs; a text shorter than ``MIN_WORDS`` has no runs; runs
may overlap; repeated rows are treated alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

MIN_WORDS, REPEATS = 24, 3
_BASE = np.uint64(0x9E3779B97F4A7C15)

Words = list[bytes]


def lyndon_array(symbols: np.ndarray) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, by Baier's grouping."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, n))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group = np.empty(n, np.int64)
    group[order] = np.repeat(first, sizes)
    # ``sorted_by_group`` holds positions; a group is named by its first slot and ends at ``last`` of it.
    sorted_by_group, place, group = order.tolist(), place.tolist(), group.tolist()
    last = dict(zip(first.tolist(), (first + sizes - 1).tolist(), strict=True))
    lengths = [1] * n
    lower = list(range(n))  # union-find: the nearest position at or left of this one in a lower group

    slot = n - 1
    while slot >= 0:
        start = group[sorted_by_group[slot]]
        members = sorted_by_group[start : slot + 1]
        width = lengths[members[0]]
        for i in members:
            lower[i] = i - 1
        taken: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and lower[j] != j:
                j = lower[j]
            k = i - 1
            while k > j:
                lower[k], k = j, lower[k]
            if j >= 0:
                taken[j] = taken.get(j, 0) + 1
        for times in sorted(set(taken.values()), reverse=True):
            moved: dict[int, int] = {}
            for j, t in taken.items():
                if t != times:
                    continue
                g = group[j]
                m = moved.get(g, 0)
                to, at = last[g] - m, place[j]
                other = sorted_by_group[to]
                sorted_by_group[to], sorted_by_group[at] = j, other
                place[j], place[other] = to, at
                moved[g] = m + 1
                lengths[j] += times * width
            for g, m in moved.items():
                end = last[g]
                new = end - m + 1
                if new > g:
                    last[new], last[g] = end, new - 1
                    for p in sorted_by_group[new : end + 1]:
                        group[p] = new
        slot = start - 1
    return lengths


class Extensions:
    """Longest common extensions between places, from ranks of blocks whose widths double."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.ranks = [symbols.astype(np.int64)]
        while (width := 1 << len(self.ranks)) <= self.n:
            low = self.ranks[-1]
            both = low[: self.n - width + 1] * (self.n + 1) + low[width // 2 : self.n - width // 2 + 1]
            self.ranks.append(np.unique(both, return_inverse=True)[1].astype(np.int64))

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j on agree (i < j)."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks, top = self.ranks[k], self.n - (1 << k)
            fits = j + out <= top
            same = fits & (ranks[np.where(fits, i + out, 0)] == ranks[np.where(fits, j + out, 0)])
            out += same.astype(np.int64) << k
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols up to and with i and j agree (i < j)."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks, width = self.ranks[k], 1 << k
            fits = i - out - width + 1 >= 0
            same = fits & (ranks[np.where(fits, i - out - width + 1, 0)] == ranks[np.where(fits, j - out - width + 1, 0)])
            out += same.astype(np.int64) << k
        return out


def runs_of(symbols: np.ndarray, min_words: int = MIN_WORDS, repeats: int = REPEATS) -> np.ndarray:
    """(start, length, period) rows of the runs of a sequence, by start, then period."""
    n = len(symbols)
    found = [np.zeros((0, 3), np.int64)]
    if n >= min_words:
        dense = np.unique(symbols, return_inverse=True)[1]
        extensions = None
        for ordered in (dense, dense.max() - dense):
            period = np.array(lyndon_array(ordered), np.int64)
            # The first root of a run starts within its first period, so it occurs this often again behind itself.
            again = max(0, repeats - 2)
            i = np.flatnonzero(np.arange(n) + (1 + again) * period <= n)
            if again:
                i = i[dense[i] == dense[i + period[i]]]
            if not len(i):
                continue
            extensions = extensions or Extensions(dense)
            p = period[i]
            right = extensions.forward(i, i + p)
            i, p, right = (x[right >= again * p] for x in (i, p, right))
            left = extensions.backward(i - 1, i + p - 1)
            length = p + right + left
            good = length >= np.maximum(min_words, repeats * p)
            found.append(np.stack([i - left, length, p], axis=1)[good])
    distinct = np.unique(np.concatenate(found), axis=0)
    return distinct[np.lexsort((distinct[:, 2], distinct[:, 0]))]


def stretches(symbols: np.ndarray, min_words: int = MIN_WORDS, repeats: int = REPEATS) -> Iterator[tuple[int, int]]:
    """Ranges of places outside of which there is no run."""
    n, gram = len(symbols), min_words * (repeats - 2) // repeats
    if n < min_words:
        return
    if gram < 1:
        yield 0, n
        return
    grams = np.zeros(n - gram + 1, np.uint64)
    for k in range(gram):
        grams = (grams ^ (grams >> np.uint64(29))) * _BASE + symbols[k : n - gram + 1 + k].astype(np.uint64) + np.uint64(1)
    _, back, times = np.unique(grams, return_inverse=True, return_counts=True)
    edges = np.diff(np.concatenate([[0], (times[back] > 1).astype(np.int8), [0]]))
    for lo, hi in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
        if hi + gram - 1 - lo >= min_words:
            yield lo, hi + gram - 1


def word_runs(words: Words, min_words: int = MIN_WORDS, repeats: int = REPEATS) -> np.ndarray:
    """(start, length, period) rows of the runs of a text's words."""
    numbers: dict[bytes, int] = {}
    symbols = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = [np.zeros((0, 3), np.int64)]
    for lo, hi in stretches(symbols, min_words, repeats):
        rows = runs_of(symbols[lo:hi], min_words, repeats)
        rows[:, 0] += lo
        found.append(rows)
    return np.concatenate(found)


def collapsed(words: Words, runs: np.ndarray) -> bytes:
    """The words less those that a run repeats after its first period, joined by blanks."""
    if not len(runs):
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(w for w, inside in zip(words, np.cumsum(marks).tolist(), strict=False) if not inside)


def plain_words(row_id: int | None, text: str | None) -> Words:
    """Words of a text as bytes; only ASCII white space parts them."""
    return (text or "").encode().split()


def periodic_runs(
    docs: DataFrame,
    words_of: Callable[[int | None, str | None], Words] = plain_words,
    min_words: int = MIN_WORDS,
    repeats: int = REPEATS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period), collapsed (text without the repeats) of every row."""

    def work(ids, texts):
        out: list[list] = [ids, [], [], []]
        for i, text in zip(ids, texts, strict=True):
            words = words_of(i, text)
            runs = word_runs(words, min_words, repeats)
            out[1].append(len(words))
            out[2].append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()])
            out[3].append(collapsed(words, runs).decode())
        return out

    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_rows(docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")), ["id", "text"], work, schema)
