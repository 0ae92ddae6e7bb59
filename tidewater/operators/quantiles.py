"""Exact continuous quantiles without gathering the values in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


@dataclass
class _Search:
    """Looks for the value at one sorted position; it lies in ``[low, high]``."""

    position: int
    low: int
    high: int
    below: int = 0


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], scale: int = 2
) -> list[float | None]:
    """Interpolated quantiles of a decimal column with ``scale`` digits.

    The built-in exact percentile merges all distinct values into one buffer. Here each pass only
    counts rows per value bucket, keeps the bucket that holds the wanted position and splits it
    again, until a bucket is a single value. The driver sees at most ``BUCKETS`` counts per
    position and pass; a 64-bit value range needs six passes at most.
    """
    units = df.select(
        F.round(F.col(column).cast("decimal(30,6)") * (10**scale)).cast("bigint").alias("v")
    ).filter(F.col("v").isNotNull())
    units = units.persist()
    try:
        count, low, high = units.agg(
            F.count(F.lit(1)), F.min("v"), F.max("v")
        ).first()
        if not count:
            return [None for _ in probabilities]
        places = [Decimal(str(p)) * (count - 1) for p in probabilities]
        positions = {math.floor(p) for p in places} | {math.ceil(p) for p in places}
        found = _values_at(units, sorted(positions), low, high)
    finally:
        units.unpersist()

    results = []
    for place in places:
        first, last = found[math.floor(place)], found[math.ceil(place)]
        exact = first + (place - math.floor(place)) * (last - first)
        results.append(float(exact / (10**scale)))
    return results


def _values_at(units: DataFrame, positions: list[int], low: int, high: int) -> dict[int, int]:
    searches = [_Search(p, low, high) for p in positions]
    while any(s.low < s.high for s in searches):
        open_ranges = sorted({(s.low, s.high) for s in searches if s.low < s.high})
        counts = _bucket_counts(units, open_ranges)
        for search in searches:
            if search.low == search.high:
                continue
            index = open_ranges.index((search.low, search.high))
            width = _width(search.low, search.high)
            below = search.below
            for bucket, rows in counts[index]:
                if search.position < below + rows:
                    start = search.low + bucket * width
                    search.high = min(search.high, start + width - 1)
                    search.low = start
                    search.below = below
                    break
                below += rows
            else:
                raise RuntimeError("input changed while quantiles were computed")
    return {s.position: s.low for s in searches}


def _width(low: int, high: int) -> int:
    return -(-(high - low + 1) // BUCKETS)


def _bucket_counts(
    units: DataFrame, ranges: list[tuple[int, int]]
) -> dict[int, list[tuple[int, int]]]:
    hits = [
        F.when(
            F.col("v").between(low, high),
            F.struct(
                F.lit(i).alias("i"),
                F.expr(f"(v - {low}L) div {_width(low, high)}L").alias("b"),
            ),
        )
        for i, (low, high) in enumerate(ranges)
    ]
    rows = (
        units.select(F.explode(F.array_compact(F.array(*hits))).alias("hit"))
        .groupBy("hit.i", "hit.b")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    counts: dict[int, list[tuple[int, int]]] = {i: [] for i in range(len(ranges))}
    for i, bucket, n in sorted(tuple(r) for r in rows):
        counts[i].append((bucket, n))
    return counts
