"""Byte-pair encoding by a compiled tokenization automaton, and decoding by its arc labels.

The automaton reads tokens and accepts exactly the sequences that byte-pair encoding produces. It starts as one
state with an arc for every byte and is built by successive merge gadgets, in order of the merges. The gadget for
(a, b) copies the state behind ``a`` without its ``b`` arc, leads all ``a`` arcs to the copy and adds an arc ``ab``
wherever ``a`` then ``b`` could be read. All arcs of one token lead to one state at any time, so states are
numbered by tokens. Arc sets are kept as their construction history: a state is a copy, made at its token's merge,
of the state of the token's right part, and an arc came with its own token's merge from the arc of the left part.
``Automaton.has_arc`` follows that history; answers go into a transition table, which encoding reads. Written out,
50,000 merges would take billions of arcs.

A pre-split word has one accepting path. ``encode_word`` walks arcs longest label first; at most one state can be
reached at a place of the word, so each place is tried once. ``decode`` emits the arcs' labels.

Defined results: null and empty texts have no tokens and decode to the empty text; repeated rows are encoded each;
an empty table gives no rows; other columns are not read. The special token's string inside a text is its token.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows
from .heap_counts import byte_symbols
from .pieces import SPECIAL_MARK, PieceCache, ragged

#: Transitions that a worker remembers before it starts over.
MAX_TRANSITIONS = 1_000_000


class Automaton:
    """The compiled merges: labels, arcs and their history."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], specials: dict[str, int]):
        to_byte = {s: b for b, s in enumerate(byte_symbols())}
        spelled = {t: bytes(to_byte[c] for c in t) for t in vocab}
        size = max([*vocab.values(), *specials.values()]) + 1
        self.labels: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.labels[i] = spelled[t]
        for t, i in specials.items():
            self.labels[i] = t.encode()
        self.made = [-1] * size  # the merge that added a token's arcs; bytes are there from the start
        self.left, self.right = [0] * size, [0] * size
        self.removed: dict[tuple[int, int], int] = {}  # arc b of state a: the merge that took it away
        self.table: dict[tuple[int, int], bool] = {}
        self.arcs: dict[bytes, int] = {spelled[t]: vocab[t] for t in to_byte if t in vocab}
        for k, (a, b) in enumerate(merges):
            self._gadget(k, vocab[a], vocab[b], vocab[a + b])
        self.longest = max(map(len, self.arcs), default=0)
        self.table.clear()

    def _gadget(self, k: int, a: int, b: int, ab: int) -> None:
        """Add merge k. No arc ``ab`` arises if no ``b`` arc leaves the state behind ``a`` by now."""
        if self.made[ab] >= 0 or self.labels[ab] in self.arcs or not self._had_arc(a, b, k):
            return
        self.removed[a, b] = k
        self.made[ab], self.left[ab], self.right[ab] = k, a, b
        self.arcs[self.labels[ab]] = ab

    def _had_arc(self, state: int, token: int, k: int) -> bool:
        """Whether the state had the token's arc when merge k was about to be added."""
        made, left, right, removed = self.made, self.left, self.right, self.removed
        while True:
            if removed.get((state, token), k) < k:
                return False
            s, t = made[state], made[token]
            if s < 0 and t < 0:
                return True
            if s > t:  # the state is a copy that its merge made of the right part's state
                state, k = right[state], s
            elif s < t:  # the arc came from the arc of the left part; of a doubled token, after its gadget's removal
                token, k = left[token], t + 1
            else:  # the same token twice: its state was copied before its own arc came
                token, k = left[token], t + 1
                if removed.get((state, token), k) < k:
                    return False
                state, k = right[state], t

    def has_arc(self, state: int, token: int) -> bool:
        key = (state, token)
        got = self.table.get(key)
        if got is None:
            if len(self.table) > MAX_TRANSITIONS:
                self.table.clear()
            got = self.table[key] = self._had_arc(state, token, len(self.labels) + 1)
        return got

    def encode_word(self, word: bytes) -> list[int]:
        """Tokens of the word's accepting path."""
        n, arcs = len(word), self.arcs
        path: list[tuple[int, int, int]] = []  # place, token, end
        tried = bytearray(n + 1)
        place, end = 0, min(n, self.longest)
        while place < n:
            state = path[-1][1] if path else -1
            while end > place:
                token = arcs.get(word[place:end])
                if token is not None and not tried[end] and (state < 0 or self.has_arc(state, token)):
                    break
                end -= 1
            if end > place:
                path.append((place, token, end))
                place, end = end, min(n, end + self.longest)
            elif path:  # no way on: this place is done, take a shorter arc before it
                tried[place] = 1
                place, _, end = path.pop()
                end -= 1
            else:
                raise ValueError("the vocabulary lacks a byte of the word")
        return [token for _, token, _ in path]

    def decode(self, tokens: list[int]) -> str:
        """Labels of the tokens' arcs, one after the other; bytes that are no UTF-8 become U+FFFD."""
        labels = self.labels
        return b"".join([labels[t] for t in tokens]).decode("utf-8", "replace")


class Encoder:
    """Encodes and decodes texts; one per worker."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            described = json.load(f)
        model = described["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        specials = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.automaton = Automaton(model["vocab"], merges, specials)
        special = next(iter(specials), None)
        self.special = specials.get(special)
        self.ids: list[int] = []
        self.ends = [0]
        self.pieces = PieceCache(self._learn, self._forget, special)

    def _learn(self, piece: str) -> None:
        word = piece.encode("utf-8", "surrogatepass")
        self.ids += [self.special] if piece == SPECIAL_MARK else self.automaton.encode_word(word)
        self.ends.append(len(self.ids))

    def _forget(self) -> None:
        self.ids, self.ends = [], [0]

    def encode(self, texts: list) -> list[np.ndarray]:
        """Token ids of each text."""
        numbers, bounds = self.pieces.split(texts)
        ids, ends = ragged(np.asarray(self.ids, np.int64), np.asarray(self.ends, np.int64), numbers)
        cuts = np.concatenate([[0], ends])[bounds]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder for a vocabulary file; compiled once."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def encode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, ids (list of token ids) for every row."""
    return map_rows(docs, [id_column, text_column], lambda ids, texts: [ids, [x.tolist() for x in encoder(vocabulary).encode(texts)]], "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, text for rows of (doc_id, ids); null ids decode to the empty text."""

    def work(ids, tokens):
        automaton = encoder(vocabulary).automaton
        return [ids, [automaton.decode(t or []) for t in tokens]]

    return map_rows(encoded, ["doc_id", "ids"], work, "doc_id long, text string")


def round_trips(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text is encoded, and its ids are decoded again."""

    def work(ids, texts):
        coder = encoder(vocabulary)
        counts, spelled, decoded = [], [], []
        for tokens in coder.encode(texts):
            tokens = tokens.tolist()
            counts.append(len(tokens))
            spelled.append(hashlib.sha256(",".join(map(str, tokens)).encode()).hexdigest())
            decoded.append(hashlib.sha256(coder.automaton.decode(tokens).encode()).hexdigest())
        return [ids, counts, spelled, decoded]

    return map_rows(docs, [id_column, text_column], work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
