"""Token counts by heap-and-linked-list byte-pair merging.

Each distinct piece is merged once per worker: its bytes form a linked list, a heap gives the adjacent pair of
lowest rank (leftmost first), and every merge takes one symbol away. A piece's count is its bytes minus the merges;
no identifiers are made. A text's count is the sum over its pieces.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted each; an empty table
gives no rows; other columns are not read. The special token's string inside a text counts as one token, as the
library does by default.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows
from .pieces import SPECIAL_MARK, PieceCache

LIMIT = 1024


def merge_ranks(vocabulary: str) -> tuple[dict, str | None]:
    """(rank of each mergeable pair of symbols, special token) of a byte-level BPE file of the tokenizers library."""
    with open(vocabulary, encoding="utf-8") as f:
        described = json.load(f)
    pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in described["model"]["merges"])
    special = [t["content"] for t in described["added_tokens"]]
    return {pair: rank for rank, pair in enumerate(pairs)}, special[0] if special else None


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def merged_count(symbols: list[str], ranks: dict) -> int:
    """Number of symbols left after all merges."""
    n = len(symbols)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get((a, b))) is not None]
    heapq.heapify(heap)
    alive, left = symbols[:], n
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if alive[i] is not None else -1
        if j < 0 or alive[i] != a or alive[j] != b:
            continue  # one of the two has been merged meanwhile
        alive[i], alive[j] = a + b, None
        left -= 1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            if (r := ranks.get((a + b, alive[k]))) is not None:
                heapq.heappush(heap, (r, i, a + b, alive[k]))
        h = before[i]
        if h >= 0 and (r := ranks.get((alive[h], a + b))) is not None:
            heapq.heappush(heap, (r, h, alive[h], a + b))
    return left


class Counter:
    """Counts tokens of texts; one per worker."""

    def __init__(self, vocabulary: str):
        self.ranks, special = merge_ranks(vocabulary)
        self.symbols = byte_symbols()
        self.counts: list[int] = []
        self.pieces = PieceCache(self._learn, self.counts.clear, special)

    def _learn(self, piece: str) -> None:
        symbols = [self.symbols[b] for b in piece.encode("utf-8", "surrogatepass")]
        self.counts.append(1 if piece == SPECIAL_MARK else merged_count(symbols, self.ranks))

    def __call__(self, texts: list) -> list[int]:
        numbers, ends = self.pieces.split(texts)
        sums = np.concatenate([[0], np.cumsum(np.asarray(self.counts, np.int64)[numbers])]) if len(numbers) else np.zeros(1, np.int64)
        return np.diff(sums[ends]).tolist()


_COUNTERS: dict[str, Counter] = {}


def counter(vocabulary: str) -> Counter:
    """The worker's counter for a vocabulary file; loaded once."""
    if vocabulary not in _COUNTERS:
        _COUNTERS[vocabulary] = Counter(vocabulary)
    return _COUNTERS[vocabulary]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""

    def work(ids, texts):
        tokens = counter(vocabulary)(texts)
        sizes = [len(t.encode()) if t else 0 for t in texts]
        return [ids, sizes, tokens, [n > limit for n in tokens]]

    return map_rows(docs, [id_column, text_column], work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
