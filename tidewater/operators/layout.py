"""File layout on a space-filling curve, so that a filter on any of several columns skips files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Each column's values are ranked in 2 ** ``BITS`` ranges of about equal numbers of rows.
BITS = 6
#: Error bound of the range borders, as a share of the rows: 1 / ``ACCURACY``.
ACCURACY = 4096


def _ordered(df: DataFrame, column: str) -> Column:
    """A number or date in the column's order; of a text its first seven bytes count."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
    return F.col(column)


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Place of a row on a Z-curve through the ranks of its columns; NULLs rank lowest.

    The borders of the ranks are quantiles of all rows, found in one pass: (2 ** bits - 1) values a column reach
    the driver, however many rows there are.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    keys = [_ordered(df, c) for c in columns]
    borders = df.agg(*[F.percentile_approx(k, shares, ACCURACY).alias(f"b{i}") for i, k in enumerate(keys)]).first()
    ranks = []
    for key, found in zip(keys, borders, strict=True):
        steps = [F.when(key > F.lit(b), 1).otherwise(0) for b in sorted(set(found or []))]
        ranks.append(reduce(Column.__add__, steps, F.lit(0)))
    place = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            taken = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            place = place.bitwiseOR(F.shiftleft(taken, bit * len(ranks) + i))
    return place


def write_on_curve(df: DataFrame, path: str, columns: Sequence[str], partitions: int | None = None, bits: int = BITS) -> None:
    """Write so that range filters on each of ``columns`` skip files.

    Files are ranges of the curve, ties on it are split by the columns themselves, so a value that very many rows
    share is spread over several files.
    """
    placed = df.withColumn("_place", curve_place(df, columns, bits))
    order = [F.col("_place"), *[F.col(c) for c in columns]]
    ranged = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).drop("_place").write.mode("overwrite").parquet(path)
