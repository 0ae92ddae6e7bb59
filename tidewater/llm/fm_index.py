"""A compressed FM-index over integer sequences: Burrows-Wheeler transform in a wavelet matrix, batched search."""

from __future__ import annotations

import numpy as np

_ONE, _SIX = np.uint64(1), np.int64(63)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols at least, by prefix doubling."""
    rank = symbols.astype(np.int64)
    n, step = len(rank), 1
    order = np.argsort(rank, kind="stable")
    while step < depth:
        second = np.full(n, -1, np.int64)
        second[: max(0, n - step)] = rank[step:]
        key = rank * (max(n, int(rank.max()) + 1) + 2) + second + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            break
        step *= 2
    return order


class Bits:
    """A bit vector of packed words with counts before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64))

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each place."""
        word = at >> 6
        below = (_ONE << (at & _SIX).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class FMIndex:
    """Counts occurrences of patterns in ``symbols`` (0 ends a segment and is never searched for).

    Suffixes are ordered by ``depth`` symbols, which suffices for patterns up to that length.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        order = suffix_order(symbols, depth)
        last = symbols[order - 1]
        size = int(symbols.max()) + 1
        self.starts = np.append(0, np.cumsum(np.bincount(symbols, minlength=size)))
        self.levels = max(1, (size - 1).bit_length())
        self.rows: list[tuple[Bits, int]] = []
        for level in range(self.levels - 1, -1, -1):
            bits = (last >> level) & 1
            self.rows.append((Bits(bits.astype(np.uint8)), int(len(bits) - bits.sum())))
            last = np.concatenate([last[bits == 0], last[bits == 1]])
        self.size = len(symbols)

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the transform before each place."""
        lo, hi = np.zeros_like(at), at
        for level, (bits, zeros) in zip(range(self.levels - 1, -1, -1), self.rows, strict=True):
            one = ((symbols >> level) & 1).astype(bool)
            a, b = bits.ones(lo), bits.ones(hi)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo

    def matched(self, text: np.ndarray, ends: np.ndarray, most: int, least_count: int) -> np.ndarray:
        """Matching statistics: for each end in ``text``, how many symbols up to it (``most`` at most) occur together
        ``least_count`` times or more. All ends are searched backwards side by side."""
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), self.size, np.int64)
        length = np.zeros(len(ends), np.int64)
        active = np.arange(len(ends))
        for step in range(most):
            symbol = text[ends[active] - step]
            active, symbol = active[symbol > 0], symbol[symbol > 0]
            if not len(active):
                break
            a = self.starts[symbol] + self.rank(symbol, lo[active])
            b = self.starts[symbol] + self.rank(symbol, hi[active])
            good = b - a >= least_count
            active = active[good]
            lo[active], hi[active] = a[good], b[good]
            length[active] = step + 1
        return length
