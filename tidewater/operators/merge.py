"""Upsert, conditional update and delete as DataFrame transformations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MERGE_FLAG, BEFORE = "_merge", "_before"
KEPT, UPDATED, INSERTED, DELETED = "kept", "updated", "inserted", "deleted"


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    insert: Sequence[str],
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    before: bool = False,
) -> DataFrame:
    """Merge ``source`` into ``target`` on equal keys; both sides hold a key at most once.

    Matched rows take the ``update`` columns from the source and keep the rest; unmatched source
    rows are inserted with the ``insert`` columns and NULL elsewhere. ``on_update`` / ``on_insert``
    add values that are not source columns (load stamps). A NULL key matches nothing, so it is
    inserted. The result has the target's columns plus ``_merge`` (kept, updated, inserted) and, if asked for,
    ``_before``: the row an update found.
    """
    on_update = dict(on_update or {})
    on_insert = dict(on_insert or {})
    types = {f.name: f.dataType for f in target.schema}
    old = target.select(
        *[F.col(c).alias(f"_old_{c}") for c in target.columns], F.lit(True).alias("_in_old")
    )
    wanted = [c for c in source.columns if c in {*keys, *update, *insert}]
    new = source.select(
        *[F.col(c).alias(f"_new_{c}") for c in wanted], F.lit(True).alias("_in_new")
    )
    condition = None
    for key in keys:
        match = F.col(f"_old_{key}") == F.col(f"_new_{key}")
        condition = match if condition is None else condition & match
    joined = old.join(new, condition, "full_outer")

    only_old = F.col("_in_new").isNull()
    only_new = F.col("_in_old").isNull()

    def value(column: str) -> Column:
        kept = F.col(f"_old_{column}")
        if column in on_update:
            updated = on_update[column]
        elif column in update:
            updated = F.col(f"_new_{column}")
        else:
            updated = kept
        if column in on_insert:
            inserted = on_insert[column]
        elif column in insert or column in keys:
            inserted = F.col(f"_new_{column}")
        else:
            inserted = F.lit(None)
        merged = F.when(only_old, kept).when(only_new, inserted).otherwise(updated)
        return merged.cast(types[column]).alias(column)

    flag = F.when(only_old, KEPT).when(only_new, INSERTED).otherwise(UPDATED)
    found = F.struct(*[F.col(f"_old_{c}").alias(c) for c in target.columns])
    images = [F.when(~only_old & ~only_new, found).alias(BEFORE)] if before else []
    return joined.select(*[value(c) for c in target.columns], *images, flag.alias(MERGE_FLAG))


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set ``values`` on the rows where ``condition`` holds; a NULL condition leaves the row."""
    hit = F.coalesce(condition, F.lit(False))
    types = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            F.when(hit, values[c]).otherwise(F.col(c)).cast(types[c]).alias(c)
            if c in values
            else F.col(c)
            for c in df.columns
        ]
    )


def stale_customers(as_of: Column, days: int = 90) -> Column:
    """Active customers whose last order is more than ``days`` before ``as_of``."""
    return (F.col("last_order_date") < F.date_sub(as_of, days)) & F.col("is_active")


def deactivate_stale(
    ltv: DataFrame, as_of: Column, now: Column | None = None, days: int = 90
) -> DataFrame:
    """Clear ``is_active`` for stale customers. Customers without any order are left alone."""
    return update_where(
        ltv,
        stale_customers(as_of, days),
        {
            "is_active": F.lit(False),
            "load_timestamp": F.current_timestamp() if now is None else now,
        },
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows left after a delete; a NULL condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
