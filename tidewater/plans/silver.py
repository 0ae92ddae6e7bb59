"""Cleaned layer: orders, customers and line items, by full load or by change merge."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    clamp_negative,
    classify_orderstatus,
    classify_priority_rank,
    clerk_id,
)
from ..operators.changes import FEED_COLUMNS, keep_inserts
from ..operators.dedup import evenly_dealt, latest_per_key
from ..operators.store import JobResult, MergeCounts, TableStore
from ..schemas import CUSTOMER_SILVER, LINEITEM_SILVER, ORDERS_SILVER, STAGING, TableSpec
from ..streaming.feed import ChangeFeed

# -- enrichment, one row in and one row out -----------------------------------------------------


def enrich_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        classify_orderstatus(F.col("o_orderstatus")).alias("o_orderstatus_desc"),
        "o_totalprice",
        "o_orderdate",
        F.year("o_orderdate").alias("o_order_year"),
        F.month("o_orderdate").alias("o_order_month"),
        F.quarter("o_orderdate").alias("o_order_quarter"),
        "o_orderpriority",
        classify_priority_rank(F.col("o_orderpriority")).alias("o_priority_rank"),
        "o_clerk",
        clerk_id(F.col("o_clerk")).alias("o_clerk_id"),
        "o_shippriority",
        "o_comment",
        F.col("from_source").alias("source_file"),
        F.col("created_at").alias("first_loaded_at"),
    )


def enrich_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    nations = nation.select("n_nationkey", "n_name", "n_regionkey")
    regions = region.select("r_regionkey", "r_name")
    return (
        customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            "c_custkey",
            "c_name",
            "c_address",
            "c_nationkey",
            F.col("n_name").alias("c_nation_name"),
            F.col("n_regionkey").alias("c_regionkey"),
            F.col("r_name").alias("c_region_name"),
            "c_phone",
            "c_acctbal",
            "c_mktsegment",
            "c_comment",
        )
    )


def enrich_lineitem(lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    """Names of part and supplier, prices and delay.

    Both lookups are left joins on plain keys, so Spark broadcasts them while they are small and
    AQE splits a hot part or supplier key once they are not. Both prices are rounded once, the
    final one from the unrounded net price.
    """
    return _enriched(_named(lineitem, part, supplier))


def _named(lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    parts = part.select("p_partkey", "p_name", "p_type")
    suppliers = supplier.select("s_suppkey", "s_name")
    return lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left"
    )


def _enriched(named: DataFrame) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    delay = F.datediff(F.col("l_receiptdate"), F.col("l_commitdate"))
    return named.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("p_name").alias("l_part_name"),
        F.col("p_type").alias("l_part_type"),
        "l_suppkey",
        F.col("s_name").alias("l_supplier_name"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
        "l_commitdate",
        "l_receiptdate",
        "l_shipinstruct",
        "l_shipmode",
        "l_comment",
        net.cast("decimal(12,2)").alias("l_net_price"),
        (net * (1 + F.col("l_tax"))).cast("decimal(12,2)").alias("l_final_price"),
        clamp_negative(delay).alias("l_ship_delay_days"),
    )


# -- latest version per key, then enrich ---------------------------------------------------------


def _latest(rows: DataFrame, staging: str) -> DataFrame:
    return latest_per_key(rows, STAGING[staging].keys)


def orders_silver(orders: DataFrame) -> DataFrame:
    return enrich_orders(_latest(orders, "orders"))


def _latest_lookup(rows: DataFrame, staging: str, columns: tuple[str, ...]) -> DataFrame:
    """Lookup rows, one per key, so that a redelivered lookup file cannot multiply the fact rows."""
    return latest_per_key(
        rows.select(*columns, "created_at"), STAGING[staging].keys
    ).select(*columns)


def customer_silver(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Deduplicated before the lookups: fewer rows are joined and the result is the same."""
    return enrich_customer(_latest(customer, "customer"), nation, region)


def lineitem_silver(lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    return enrich_lineitem(_latest(lineitem, "lineitem"), part, supplier)


# -- the same for a stored table -----------------------------------------------------------------

#: Lookups of up to so many rows (about 150 MB in memory) are broadcast.
BROADCAST_ROWS = 1_500_000


def stored_orders(orders: DataFrame, partitions: int | None) -> DataFrame:
    """Cleaned orders, exchanged once: to the partitions that the table is written or merged from."""
    if partitions and evenly_dealt(orders, STAGING["orders"].keys, partitions):
        orders = orders.repartition(partitions, *STAGING["orders"].keys)
    return orders_silver(orders)


def stored_lineitem(
    lineitem: DataFrame, part: DataFrame, supplier: DataFrame, partitions: int | None, batch: bool = False
) -> DataFrame:
    """Cleaned line items for a table that goes on from ``partitions`` by key.

    Unless a key has very many versions, line items go to those partitions at once: the versions are ranked there
    and the rows written from there. A lookup too large to broadcast would move all line items once more, so their
    keys alone go to it and bring its columns back. Only lines without a key cannot be found again: where there are
    some, the large lookup comes first, and its rows are held in hash tables, which needs no sort of the line items.
    """
    keys = STAGING["lineitem"].keys
    small = [lookup.count() <= BROADCAST_ROWS for lookup in (part, supplier)]
    if batch:
        part = only_needed(part, "p_partkey", lineitem, "l_partkey")
        supplier = only_needed(supplier, "s_suppkey", lineitem, "l_suppkey")
    part, supplier = (
        lookup.hint("broadcast" if fits else "shuffle_hash")
        for lookup, fits in zip((lookup_part(part), lookup_supplier(supplier)), small, strict=True)
    )
    if not partitions or not evenly_dealt(lineitem, keys, partitions):
        return lineitem_silver(lineitem, part, supplier)
    if all(small):
        return lineitem_silver(lineitem.repartition(partitions, *keys), part, supplier)
    if not lineitem.where(reduce(Column.__or__, [F.col(k).isNull() for k in keys])).isEmpty():
        order = [c for c in lineitem.columns if c not in {*keys, "created_at"}]
        named = _named(lineitem, part, supplier).repartition(partitions, *keys)
        return _enriched(latest_per_key(named, keys, tie_break=order))
    named = _latest(lineitem.repartition(partitions, *keys), "lineitem")
    lookups = ((part, "p_partkey", "l_partkey"), (supplier, "s_suppkey", "l_suppkey"))
    for (lookup, key, of), fits in zip(lookups, small, strict=True):
        if fits:
            named = named.join(lookup, F.col(of) == F.col(key), "left")
        else:
            named = _brought(named, lineitem, lookup, key, of, partitions)
    return _enriched(named)


def _brought(latest: DataFrame, lineitem: DataFrame, lookup: DataFrame, key: str, of: str, partitions: int) -> DataFrame:
    """Columns of a large lookup joined to ``latest`` where its rows are.

    Any version of a line may turn out to be the latest, so a line gets the lookup's rows of all its versions and
    keeps the one it refers to.
    """
    keys = STAGING["lineitem"].keys
    lines = lineitem.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col(of).alias("_refers"))
    places = [f"_of_{k}" for k in keys]
    found = lines.join(lookup, F.col("_refers") == F.col(key)).drop("_refers").repartition(partitions, *places).distinct()
    of_line = reduce(Column.__and__, [F.col(k) == F.col(f"_of_{k}") for k in keys])
    # Not an equality, which would ask for partitions by this column too.
    same = (F.col(of) <= F.col(key)) & (F.col(of) >= F.col(key))
    return latest.join(found, of_line & same, "left").drop(*places)


def lookup_nation(nation: DataFrame) -> DataFrame:
    return _latest_lookup(nation, "nation", ("n_nationkey", "n_name", "n_regionkey"))


def lookup_region(region: DataFrame) -> DataFrame:
    return _latest_lookup(region, "region", ("r_regionkey", "r_name"))


def lookup_part(part: DataFrame) -> DataFrame:
    return _latest_lookup(part, "part", ("p_partkey", "p_name", "p_type"))


def lookup_supplier(supplier: DataFrame) -> DataFrame:
    return _latest_lookup(supplier, "supplier", ("s_suppkey", "s_name"))


# -- jobs on stored tables -----------------------------------------------------------------------


def only_needed(lookup: DataFrame, key: str, rows: DataFrame, fact_key: str) -> DataFrame:
    """Lookup rows that a batch refers to.

    A daily batch names few of a large lookup's keys. The semi-join is plain: Spark broadcasts the keys
    while they are small, and shuffles both sides once they are not.
    """
    needed = rows.select(F.col(fact_key).alias("_needed")).distinct()
    return lookup.join(needed, F.col(key) == F.col("_needed"), "left_semi")


@dataclass(frozen=True)
class SilverJob:
    """How one staging table becomes its cleaned table.

    ``build`` gets the store, the staged rows, whether they are one batch of changes, and the partitions by key
    from which the target is written or merged.
    """

    staging: str
    target: TableSpec
    build: Callable[[TableStore, DataFrame, bool, int | None], DataFrame]
    stamp: str
    insert_only: tuple[str, ...] = ()

    @property
    def feed_name(self) -> str:
        return f"{self.target.name}_merge"

    def feed(self, store: TableStore) -> ChangeFeed:
        return ChangeFeed(store, STAGING[self.staging], self.feed_name)


def _staged(store: TableStore, name: str) -> DataFrame:
    return store.read(STAGING[name])


ORDERS_JOB = SilverJob(
    "orders",
    ORDERS_SILVER,
    lambda store, rows, batch, partitions: stored_orders(rows, partitions),
    "last_updated_at",
    ("first_loaded_at",),
)
CUSTOMER_JOB = SilverJob(
    "customer",
    CUSTOMER_SILVER,
    lambda store, rows, batch, partitions: customer_silver(
        rows,
        lookup_nation(_staged(store, "nation")),
        lookup_region(_staged(store, "region")),
    ),
    "load_timestamp",
)


def _build_lineitem(store: TableStore, rows: DataFrame, batch: bool, partitions: int | None) -> DataFrame:
    return stored_lineitem(rows, _staged(store, "part"), _staged(store, "supplier"), partitions, batch)


LINEITEM_JOB = SilverJob("lineitem", LINEITEM_SILVER, _build_lineitem, "load_timestamp")
SILVER_JOBS = (ORDERS_JOB, CUSTOMER_JOB, LINEITEM_JOB)


def full_load(store: TableStore, job: SilverJob, now: Column | None = None) -> None:
    """Rebuild a cleaned table from all staged rows."""
    stamp = F.current_timestamp() if now is None else now
    rows = job.build(store, _staged(store, job.staging), False, store.dealt(job.target))
    store.overwrite(job.target, rows.withColumn(job.stamp, stamp))


def apply_changes(
    store: TableStore,
    job: SilverJob,
    changes: DataFrame,
    now: Column | None = None,
    keep_feed: bool = False,
    offset: tuple[str, int] | None = None,
) -> MergeCounts:
    """Upsert the insert images of a feed. Deletes in the source never remove cleaned rows.

    ``offset`` (consumer, batch) is committed together with the rows.

    The feed is read twice, once for its keys only. Reading staged batches twice is cheap; for a
    feed that is computed, as a snapshot difference is, ``keep_feed`` persists it in between.
    """
    stamp = F.current_timestamp() if now is None else now
    images = keep_inserts(changes).drop(*FEED_COLUMNS)
    if keep_feed:
        images = images.persist()
    source = job.build(store, images, True, store.dealt(job.target))
    copied = [c for c in source.columns if c not in job.target.keys]
    try:
        return store.merge(
            job.target,
            source,
            update=[c for c in copied if c not in job.insert_only],
            insert=copied,
            on_update={job.stamp: stamp},
            on_insert={job.stamp: stamp},
            keys_from=images.select(*job.target.keys),
            offset=offset,
        )
    finally:
        if keep_feed:
            images.unpersist()


def merge_changes(store: TableStore, job: SilverJob, now: Column | None = None) -> JobResult:
    """Apply what is waiting in the job's feed and move the feed forward, both or neither."""
    store.recover(job.target)
    # Counted, searched for blocks and merged: the net changes are found once.
    pending = job.feed(store).pending(keep=True)
    try:
        if not pending.count:
            return JobResult(0, f"{job.target.name}: no waiting changes")
        counts = apply_changes(store, job, pending.rows, now, offset=(job.feed_name, pending.upto))
    finally:
        pending.release()
    return JobResult(
        counts.affected,
        f"{job.target.name}: {counts.affected} rows affected from {pending.count} change rows",
    )


def merge_orders_cdc(store: TableStore) -> JobResult:
    return merge_changes(store, ORDERS_JOB)


def merge_customer_cdc(store: TableStore) -> JobResult:
    return merge_changes(store, CUSTOMER_JOB)


def merge_lineitem_cdc(store: TableStore) -> JobResult:
    return merge_changes(store, LINEITEM_JOB)


def full_load_orders(store: TableStore) -> None:
    full_load(store, ORDERS_JOB)


def full_load_customer(store: TableStore) -> None:
    full_load(store, CUSTOMER_JOB)


def full_load_lineitem(store: TableStore) -> None:
    full_load(store, LINEITEM_JOB)
