"""Keep the latest version of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RANK_COLUMN = "_rank"
#: A partition may get this many times the mean before its rows count as unevenly dealt.
UNEVEN = 2


def evenly_dealt(df: DataFrame, keys: Sequence[str], partitions: int) -> bool:
    """Whether a hash of the keys deals the rows about evenly: no key has very many of them.

    Reads the keys alone; one number for each partition is shuffled.
    """
    place = F.pmod(F.hash(*keys), F.lit(partitions))
    dealt = df.groupBy(place.alias("_place")).agg(F.count(F.lit(1)).alias("_rows"))
    most, rows = dealt.agg(F.max("_rows"), F.sum("_rows")).first()
    return most is None or most * partitions <= UNEVEN * rows


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str = "created_at",
    nulls: str = "first",
    tie_break: Sequence[str] | None = None,
    keep_rank: bool = False,
) -> DataFrame:
    """One row per key: the newest version. ``keep_rank`` leaves the row number in ``_rank``.

    ``nulls="first"`` ranks unstamped rows as newest, the host dialect's order for a descending
    sort; ``"last"`` ranks them oldest. Equal stamps are ordered by ``tie_break`` (default: every
    other column), so a rerun picks the same row.

    Filtering the rank to 1 lets Spark apply its group limit before the shuffle as well, so each
    map task sends at most one row per key and a key with very many versions is not a hot spot.
    """
    if nulls not in ("first", "last"):
        raise ValueError("nulls must be 'first' or 'last'")
    stamp = F.col(order_by)
    newest = stamp.desc_nulls_first() if nulls == "first" else stamp.desc_nulls_last()
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in {*keys, order_by}]
    order = [newest, *[F.col(c).asc_nulls_first() for c in tie_break]]
    ranked = df.withColumn(
        RANK_COLUMN, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    latest = ranked.filter(F.col(RANK_COLUMN) == 1)
    return latest if keep_rank else latest.drop(RANK_COLUMN)
