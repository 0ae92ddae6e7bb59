"""Row-level change feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .dedup import evenly_dealt

ACTION = "_action"
IS_UPDATE = "_is_update"
ROW_ID = "_row_id"
INSERT, DELETE = "INSERT", "DELETE"
FEED_COLUMNS = (ACTION, IS_UPDATE, ROW_ID)


def row_id(keys: Sequence[str]) -> Column:
    """Stable identifier of a keyed row: it stays the same when the row is updated."""
    return F.md5(F.to_json(F.struct(*[F.col(k) for k in keys])))


def append_feed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed of newly appended rows: inserts only."""
    return rows.select(
        "*",
        F.lit(INSERT).alias(ACTION),
        F.lit(False).alias(IS_UPDATE),
        row_id(keys).alias(ROW_ID),
    )


def table_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Difference of two snapshots that hold each key at most once.

    A new key gives an INSERT row, a vanished key a DELETE row, and a changed row a DELETE with the
    old values plus an INSERT with the new ones, both flagged ``_is_update``. Unchanged rows give
    nothing. Keys and values are compared null-safely. Collapse a table that keeps several versions
    of a key with ``latest_per_key`` first.
    """
    columns = after.columns
    values = [c for c in columns if c not in keys]
    old = before.select(F.struct(*columns).alias("_old"), *[F.col(k).alias(f"_o_{k}") for k in keys])
    new = after.select(F.struct(*columns).alias("_new"), *[F.col(k).alias(f"_n_{k}") for k in keys])
    condition = None
    for key in keys:
        match = F.col(f"_o_{key}").eqNullSafe(F.col(f"_n_{key}"))
        condition = match if condition is None else condition & match

    in_old, in_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    same = F.lit(True)
    for column in values:
        same = same & F.col(f"_old.{column}").eqNullSafe(F.col(f"_new.{column}"))
    both = in_old & in_new

    def image(side: str, action: str) -> Column:
        return F.struct(
            F.col(side).alias("row"), F.lit(action).alias("action"), both.alias("is_update")
        )

    images = F.array_compact(
        F.array(
            F.when(in_old, image("_old", DELETE)),
            F.when(in_new, image("_new", INSERT)),
        )
    )
    changed = old.join(new, condition, "full_outer").filter(~(both & same))
    return (
        changed.select(F.explode(images).alias("change"))
        .select(
            "change.row.*",
            F.col("change.action").alias(ACTION),
            F.col("change.is_update").alias(IS_UPDATE),
        )
        .withColumn(ROW_ID, row_id(keys))
    )


def narrowed(images: DataFrame, keys: Sequence[str], wanted: Sequence[str], also: Sequence[str]) -> DataFrame:
    """Change images of keys, ``wanted`` and ``also`` alone; the other columns become one hash.

    With it, rows that differ in any column stay apart: they net to as many changes as whole rows do.
    """
    kept = [c for c in images.columns if c in {*keys, *wanted, *also, ACTION}]
    rest = [c for c in images.columns if c not in {*kept, IS_UPDATE}]
    # A hash passes NULLs over, so which columns hold one is hashed too.
    parts = [part for c in rest for part in (F.col(c), F.col(c).isNull())]
    return images.select(*kept, F.xxhash64(*parts).alias("_rest")) if rest else images.select(*kept)


def net_changes(images: DataFrame, keys: Sequence[str], origin: str) -> DataFrame:
    """What a sequence of change images comes to: rows there before and not after, and the other way round.

    A row that one write adds and a later one takes away cancels out, as often as it occurs. What is left of
    a key on both sides, from the same ``origin``, is an update. ``images`` hold the table's columns,
    ``origin`` and ``_action``. Unless a key has very many images, they are exchanged once, by key.
    """
    columns = [c for c in images.columns if c not in (ACTION, IS_UPDATE)]
    even = evenly_dealt(images, keys, int(images.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if even:
        images = images.repartition(*keys)
    sign = F.when(F.col(ACTION) == INSERT, 1).otherwise(-1)
    net = images.groupBy(*columns).agg(F.sum(sign).alias("_net")).where("_net <> 0").withColumn(ROW_ID, row_id(keys))
    if even:
        of_key = Window.partitionBy(*keys, origin)
        net = net.withColumn(IS_UPDATE, F.min("_net").over(of_key) * F.max("_net").over(of_key) < 0)
    else:
        sides = net.groupBy(F.col(ROW_ID).alias("_id"), F.col(origin).alias("_from")).agg(
            (F.min("_net") * F.max("_net") < 0).alias(IS_UPDATE)
        )
        net = net.join(sides, (F.col(ROW_ID) == F.col("_id")) & F.col(origin).eqNullSafe(F.col("_from")))
    return (
        net.withColumn(ACTION, F.when(F.col("_net") > 0, INSERT).otherwise(DELETE))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.abs("_net"))))
        .select(*columns, ACTION, IS_UPDATE, ROW_ID)
    )


def keep_inserts(feed: DataFrame) -> DataFrame:
    """Rows to apply: insert images. An update shows up here as its new image; deletes do not."""
    return feed.filter(F.col(ACTION).isin(INSERT, "UPDATE"))


def newest_changes(
    feed: DataFrame, keys: Sequence[str], stamp: str = "created_at"
) -> DataFrame:
    """Inspection view: stamped change rows, newest first.

    Equal stamps are ordered by key, which also lets the sort split a stamp shared by very many
    rows over several tasks.
    """
    return feed.filter(F.col(stamp).isNotNull()).orderBy(
        F.col(stamp).desc_nulls_first(), *keys, ACTION
    )


def pending_count(feed: DataFrame) -> int:
    """Number of change rows waiting to be applied."""
    return feed.count()
