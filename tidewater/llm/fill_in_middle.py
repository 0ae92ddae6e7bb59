"""Fill-in-the-middle: a text becomes prefix, suffix and middle between marks, or stays plain.

A text is cut into units (white space with the word after it; closing white space is a unit). The units form an
indexable skip list: the lowest lane has a node per unit, each lane above a node per ``FANOUT`` of the lane below, and
every node carries the units and the code points that a step over it skips. A cut rank is reached by descending from
the highest lane: step while the accumulated units stay within the rank, then go down. The code points accumulated on
the way are the place of the cut, so both cuts fall exactly between units.

Ranks and form come from SHA-256 of ``<seed>:<id>``, so a row gives the same result wherever and whenever it runs.

Defined results: a null or empty text is plain and empty; a text that holds a mark is plain; a text with one unit is
cut before or after it, so pieces may be empty; a null id hashes as ``<seed>:``; repeated rows are treated alike; an
empty table gives no rows; other columns are not read. A text is handled alone, however long.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 42
#: Percent of texts that are transformed, and of those the percent with the suffix first.
RATE, SUFFIX_FIRST = 50, 80
FANOUT = 8


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit of the text."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    blank = (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    if len(codes) and blank[-1]:
        ends = np.append(ends, len(codes))
    return np.diff(ends, prepend=0)


class SkipList:
    """Lanes over units; a node of a lane holds how many units and code points it spans."""

    def __init__(self, widths: np.ndarray, fanout: int = FANOUT):
        self.fanout = fanout
        self.units = len(widths)
        self.lanes = [(np.ones(len(widths), np.int64), widths)]
        while len(self.lanes[-1][0]) > fanout:
            units, points = self.lanes[-1]
            towers = np.arange(0, len(units), fanout)
            self.lanes.append((np.add.reduceat(units, towers), np.add.reduceat(points, towers)))

    def code_points(self, rank: int) -> int:
        """Code points before the unit of this rank (the number of units: all)."""
        node = passed = points = 0
        for lane_units, lane_points in reversed(self.lanes):
            while node < len(lane_units) and passed + lane_units[node] <= rank:
                passed += int(lane_units[node])
                points += int(lane_points[node])
                node += 1
            node *= self.fanout
        return points


def draws(row_id: int | None, seed: int = SEED) -> tuple[int, ...]:
    """Four unsigned 32-bit numbers of an id."""
    digest = hashlib.sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def split(text: str, row_id: int | None, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix and of middle, output) of one text."""
    lanes = SkipList(unit_widths(text))
    first, second, chance, order = draws(row_id, seed)
    if not text or chance % 100 >= rate or any(m in text for m in MARKS):
        return lanes.units, PLAIN, None, None, text
    low, high = sorted((first % (lanes.units + 1), second % (lanes.units + 1)))
    a, b = lanes.code_points(low), lanes.code_points(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < suffix_first:
        return lanes.units, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return lanes.units, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def joined(output: str, form: str) -> str:
    """The text that an output was made from."""
    if form == PLAIN:
        return output
    outer, middle = output.split(MIDDLE)
    if form == SPM:
        suffix, prefix = outer.removeprefix(SUFFIX).split(PREFIX)
    else:
        prefix, suffix = outer.removeprefix(PREFIX).split(SUFFIX)
    return prefix + middle + suffix


def transform(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output of every row."""

    def work(ids, texts):
        rows = [split(t or "", i, seed, rate, suffix_first) for i, t in zip(ids, texts, strict=True)]
        return [ids, *(list(c) for c in zip(*rows, strict=True))]

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_rows(docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")), ["id", "text"], work, schema)


def restore(transformed: DataFrame) -> DataFrame:
    """The rows of ``transform`` with the text rebuilt from output and form alone."""
    columns = ["doc_id", "n", "prefix_chars", "middle_chars", "form", "output"]

    def work(ids, units, prefixes, middles, forms, outputs):
        return [ids, units, prefixes, middles, forms, outputs, [joined(o, f) for o, f in zip(outputs, forms, strict=True)]]

    schema = "doc_id long, n long, prefix_chars long, middle_chars long, form string, output string, restored string"
    return map_rows(transformed, columns, work, schema)
