"""Vectorised pre-splitting for the public byte-level vocabularies.

The split is the one of the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``,
computed over arrays of code points: a piece starts where the character class changes; the last white-space
character before other text stands alone, or joins the text if it is a blank; an apostrophe that is neither
preceded by a blank nor by its like takes a contraction's letters. Pieces are looked up by a 64-bit hash, so the
Python code per piece runs once for every distinct piece that a worker keeps.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

LETTER, NUMBER, OTHER, SPACE, BREAK, SPECIAL = range(6)
#: Lone surrogates cannot occur in UTF-8 columns: they mark ends of texts and special tokens.
TEXT_END, SPECIAL_MARK = "\ud800", "\ud801"
#: A longer text is cut before a blank between two words, where every split has a boundary.
SAFE_CUT = regex.compile(r"(?<=\p{L}) (?=\p{L})")
LONG_TEXT = 4_000_000
#: Longer pieces are looked up by their characters, not by hash.
LONG_PIECE = 256
#: Distinct pieces that a worker remembers before it starts over.
MAX_PIECES = 500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)


def character_classes() -> np.ndarray:
    """Class of every code point."""
    classes = np.full(0x110000, OTHER, np.uint8)
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    text = "".join(points)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            classes[codes[m.start() : m.end()]] = kind
    classes[ord(TEXT_END)], classes[ord(SPECIAL_MARK)] = BREAK, SPECIAL
    return classes


def boundaries(codes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each place."""
    kinds = classes[codes]
    starts = np.empty(len(codes), bool)
    starts[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
    starts |= kinds >= BREAK
    last_space = (kinds[:-1] == SPACE) & (kinds[1:] < SPACE)
    starts[:-1] |= last_space
    starts[1:] &= ~(last_space & (codes[:-1] == 0x20))
    marks = np.flatnonzero((codes[:-1] == 0x27) & starts[:-1] & (kinds[1:] == LETTER))
    if len(marks):
        one = codes[marks + 1]
        two = codes[np.minimum(marks + 2, len(codes) - 1)]
        short = np.isin(one, [ord(x) for x in "stmd"])
        long = ((two == ord("e")) & np.isin(one, [ord("r"), ord("v")])) | ((one == ord("l")) & (two == ord("l")))
        long &= marks + 2 < len(codes)
        taken, ends = marks[short | long], (marks + 2 + long)[short | long]
        starts[taken + 1] = False
        starts[ends[ends < len(codes)]] = True
    return starts


class PieceCache:
    """Splits texts and numbers their pieces; ``learn(piece)`` is called once for each new number.

    ``learn`` gets the piece's text (the special token's mark for that) in order of numbers from 0;
    ``forget()`` is called when the numbers start over.
    """

    def __init__(self, learn: Callable[[str], None], forget: Callable[[], None], special: str | None = None):
        self.learn, self.forget, self.special = learn, forget, special
        self.classes = character_classes()
        self.known: dict = {}
        self.powers = self.inverses = np.ones(1, np.uint64)

    def split(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all pieces in order, places where each text's pieces start, with the end)."""
        if len(self.known) > MAX_PIECES:
            self.known.clear()
            self.forget()
        parts, owner = [], []
        for i, text in enumerate(texts):
            for part in cut_long(text or "", LONG_TEXT):
                parts.append(part)
                owner.append(i)
        joined = TEXT_END.join(parts)
        if self.special:
            joined = joined.replace(self.special, SPECIAL_MARK)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        places = np.flatnonzero(boundaries(codes, self.classes))
        ends = np.append(places[1:], len(codes))
        real = self.classes[codes[places]] != BREAK
        part_ends = np.append(places[~real], len(codes))
        lo, hi = places[real], ends[real]
        numbers = self._numbers(joined, codes, lo, hi)
        per_part = np.diff(np.searchsorted(lo, part_ends), prepend=0)
        per_text = np.bincount(owner, weights=per_part, minlength=len(texts)).astype(np.int64)
        return numbers, np.concatenate([[0], np.cumsum(per_text)])

    def _numbers(self, joined: str, codes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(codes):
            n = len(codes) + 1
            self.powers, self.inverses = (np.full(n, x, np.uint64) for x in (_BASE, _INVERSE))
            for x in (self.powers, self.inverses):
                x[0] = 1
                np.cumprod(x, out=x)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes + np.uint64(1)) * self.powers[: len(codes)], out=sums[1:])
        hashes = (sums[hi] - sums[lo]) * self.inverses[lo] + (hi - lo).astype(np.uint64) * _LENGTH
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        found = list(map(self.known.get, keys))
        missing = [k for k, number in enumerate(found) if number is None]
        for k, a, b in zip(missing, lo[first[missing]].tolist(), hi[first[missing]].tolist(), strict=True):
            # a long piece is looked up by its characters instead
            found[k] = 0 if b - a > LONG_PIECE else self._number(keys[k], joined[a:b])
        numbers = np.array(found, np.int64)[back]
        for i in np.flatnonzero(hi - lo > LONG_PIECE).tolist():
            piece = joined[lo[i] : hi[i]]
            numbers[i] = self._number(piece, piece)
        return numbers

    def _number(self, key: int | str, piece: str) -> int:
        got = self.known.get(key)
        if got is None:
            got = self.known[key] = len(self.known)
            self.learn(piece)
        return got


def cut_long(text: str, most: int) -> list[str]:
    """The text, or parts of it cut at places where a piece always starts."""
    if len(text) <= most:
        return [text]
    parts, lo = [], 0
    while len(text) - lo > most and (m := SAFE_CUT.search(text, lo + most)):
        parts.append(text[lo : m.start()])
        lo = m.start()
    return [*parts, text[lo:]]


def ragged(values: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of ``values[offsets[i]:offsets[i+1]]`` for i in which, and the ends of its parts."""
    lengths = offsets[which + 1] - offsets[which]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    places = np.arange(total) + np.repeat(offsets[which] - (ends - lengths), lengths)
    return values[places], ends
