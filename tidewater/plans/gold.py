"""Reporting layer: daily sales and customer lifetime value."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify_customer_revenue
from ..operators.changes import ACTION, INSERT
from ..operators.merge import stale_customers
from ..operators.store import JobResult, TableStore
from ..schemas import CUSTOMER_LTV, CUSTOMER_SILVER, CUSTOMER_TOTALS, DAILY_CUSTOMERS, DAILY_SALES_SUMMARY, ORDERS_SILVER
from ..streaming.feed import ChangeFeed

LOOKBACK_DAYS = 7
ACTIVE_DAYS = 90
DEFAULT_AS_OF = date(1998, 9, 2)

_REPORT_MONEY = "decimal(15,2)"


def high_water_mark(orders: DataFrame) -> date | None:
    """Newest order date; None for an empty table."""
    return orders.agg(F.max("o_orderdate")).first()[0]


def newest_order_date(store: TableStore) -> date | None:
    """The same from the stored blocks' ranges: no order is read."""
    high = store.zones(ORDERS_SILVER).agg(F.max("high")).first()[0]
    return None if high is None else date.fromisoformat(high)


def orders_since(store: TableStore, since: date) -> DataFrame:
    """Stored orders from ``since`` on; blocks whose newest order is older are not opened."""
    blocks = store.zones(ORDERS_SILVER).where(F.col("high") >= since.isoformat()).select("block").collect()
    recent = F.col(ORDERS_SILVER.partition_column).isin([r.block for r in blocks])
    rows = store.read_partitioned(ORDERS_SILVER).where(recent & (F.col("o_orderdate") >= F.lit(since)))
    return rows.select(*ORDERS_SILVER.columns.names)


def window_start(newest: date, lookback_days: int = LOOKBACK_DAYS) -> date:
    return newest - timedelta(days=lookback_days)


# -- daily sales ---------------------------------------------------------------------------------


def daily_sales(orders: DataFrame, since: date | None = None) -> DataFrame:
    """Sales per order date, from ``since`` on.

    Order keys are unique in the cleaned orders, so counting them is the distinct count; only the
    customers need a distinct aggregate, which Spark plans without expanding the rows and with
    partial aggregation, so a day with very many orders is not a hot spot.
    """
    if since is not None:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(since))
    price = F.col("o_totalprice")
    return (
        orders.groupBy(F.col("o_orderdate").alias("summary_date"))
        .agg(
            F.count("o_orderkey").alias("total_orders"),
            F.count_distinct("o_custkey").alias("total_customers"),
            F.sum(price).cast(_REPORT_MONEY).alias("total_revenue"),
            F.avg(price).cast(_REPORT_MONEY).alias("avg_order_value"),
            F.min(price).cast(_REPORT_MONEY).alias("min_order_value"),
            F.max(price).cast(_REPORT_MONEY).alias("max_order_value"),
        )
        .select(
            "summary_date",
            F.year("summary_date").alias("order_year"),
            F.month("summary_date").alias("order_month"),
            F.quarter("summary_date").alias("order_quarter"),
            "total_orders",
            "total_customers",
            "total_revenue",
            "avg_order_value",
            "min_order_value",
            "max_order_value",
        )
    )


_DAILY_INSERT_ONLY = ("order_year", "order_month", "order_quarter")


def load_daily_sales_summary(
    store: TableStore,
    lookback_days: int = LOOKBACK_DAYS,
    now: Column | None = None,
    newest: date | None = None,
) -> JobResult:
    """Recompute the days of the look-back window and upsert them; older days stay as they are.

    ``newest`` is for callers that know the newest order date.
    """
    newest = newest or newest_order_date(store)
    if newest is None:
        return JobResult(0, "daily sales: no cleaned orders")
    stamp = F.current_timestamp() if now is None else now
    since = window_start(newest, lookback_days)
    source = daily_sales(orders_since(store, since))
    measures = [c for c in source.columns if c != "summary_date"]
    # The source has one row per day of the window and is used twice: to find blocks and to merge.
    source = source.persist()
    try:
        counts = store.merge(
            DAILY_SALES_SUMMARY,
            source,
            update=[c for c in measures if c not in _DAILY_INSERT_ONLY],
            insert=measures,
            on_update={"load_timestamp": stamp},
            on_insert={"load_timestamp": stamp},
        )
    finally:
        source.unpersist()
    return JobResult(
        counts.affected, f"daily sales: {counts.affected} days affected from {since} on"
    )


# -- distinct customers that add up ---------------------------------------------------------------


def customer_bitmaps(orders: DataFrame) -> DataFrame:
    """Which customers ordered on a day: a bitmap for each day and range of customer keys.

    Partial bitmaps are built where the orders are read, so a day with very many orders is no hot spot.
    """
    key = F.col("o_custkey")
    return (
        orders.where(key.isNotNull() & F.col("o_orderdate").isNotNull())
        .groupBy(F.col("o_orderdate").alias("summary_date"), F.bitmap_bucket_number(key).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("customers"))
    )


def distinct_customers(bitmaps: DataFrame, period: Column) -> DataFrame:
    """Exact number of different customers per ``period`` of ``summary_date``, from daily bitmaps alone."""
    merged = bitmaps.groupBy(period.alias("period"), "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))
    return merged.groupBy("period").agg(F.sum(F.bitmap_count("customers")).alias("total_customers"))


def load_daily_customers(store: TableStore, lookback_days: int | None = LOOKBACK_DAYS) -> JobResult:
    """Bring the stored daily bitmaps up to date: the look-back window's days, or all days without one."""
    newest = newest_order_date(store)
    if newest is None:
        return JobResult(0, "daily customers: no cleaned orders")
    since = None if lookback_days is None else window_start(newest, lookback_days)
    orders = orders_since(store, since) if since else store.read(ORDERS_SILVER)
    source = customer_bitmaps(orders).persist()
    try:
        counts = store.merge(DAILY_CUSTOMERS, source, ["customers"], ["customers"])
    finally:
        source.unpersist()
    return JobResult(counts.affected, f"daily customers: {counts.affected} bitmaps from {since or 'the first day'} on")


# -- customer lifetime value ---------------------------------------------------------------------


def affected_customers(orders: DataFrame, customers: DataFrame, since: date) -> DataFrame:
    """Distinct keys of customers with an order, or refreshed, on or after ``since``."""
    ordered = orders.filter(F.col("o_orderdate") >= F.lit(since)).select(
        F.col("o_custkey").alias("c_custkey")
    )
    refreshed = customers.filter(
        F.col("load_timestamp") >= F.lit(since).cast("timestamp")
    ).select("c_custkey")
    return ordered.union(refreshed).distinct()


def order_totals(orders: DataFrame) -> DataFrame:
    """Order figures per customer."""
    price = F.col("o_totalprice")
    return orders.groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("total_orders"),
        F.count(price).alias("priced_orders"),
        F.sum(price).alias("total_spent"),
        F.avg(price).alias("avg_order_value"),
        F.min("o_orderdate").alias("first_order_date"),
        F.max("o_orderdate").alias("last_order_date"),
    )


def _ltv_columns(joined: DataFrame, as_of: date) -> DataFrame:
    today = F.lit(as_of)
    recent = F.lit(as_of - timedelta(days=ACTIVE_DAYS))
    spent = F.col("total_spent").cast(_REPORT_MONEY)
    return joined.select(
        "c_custkey",
        "c_name",
        "c_nation_name",
        "c_region_name",
        "c_mktsegment",
        F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        spent.alias("total_spent"),
        F.col("avg_order_value").cast(_REPORT_MONEY).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        F.datediff(today, F.col("first_order_date")).alias("customer_tenure_days"),
        classify_customer_revenue(F.col("total_spent")).alias("customer_tier"),
        F.coalesce(F.col("last_order_date") >= recent, F.lit(False)).alias("is_active"),
    )


_LTV_CUSTOMER = ("c_custkey", "c_name", "c_nation_name", "c_region_name", "c_mktsegment")


def customer_ltv(
    customers: DataFrame,
    orders: DataFrame,
    affected: DataFrame | None = None,
    as_of: date = DEFAULT_AS_OF,
    summed: bool = False,
) -> DataFrame:
    """Lifetime value of the affected customers (all without ``affected``), with or without orders.

    With ``summed``, ``orders`` are totals per customer already.

    Orders are summed per customer before any join, so a customer with very many orders is reduced
    before the shuffle. The restriction to affected keys is a semi-join over that aggregate:
    Spark moves it below the aggregate when the keys are small enough to broadcast and leaves it
    above otherwise.
    """
    average = (F.col("total_spent") / F.col("priced_orders")).cast("decimal(16,6)")
    totals = orders.withColumn("avg_order_value", average) if summed else order_totals(orders)
    chosen = customers.select(*_LTV_CUSTOMER)
    if affected is not None:
        keys = affected.select(F.col("c_custkey").alias("_key"))
        totals = totals.join(keys, F.col("o_custkey") == F.col("_key"), "left_semi")
        chosen = chosen.join(keys, F.col("c_custkey") == F.col("_key"), "left_semi")
    joined = chosen.join(totals, F.col("c_custkey") == F.col("o_custkey"), "left")
    return _ltv_columns(joined, as_of)


def customer_ltv_preview(
    customers: DataFrame, orders: DataFrame, since: date, as_of: date = DEFAULT_AS_OF
) -> DataFrame:
    """Orders-rooted variant: only customers with an order on or after ``since``.

    Orders without a customer row are kept and form one group, as the left join asks.
    """
    keys = (
        orders.filter(F.col("o_orderdate") >= F.lit(since))
        .select(F.col("o_custkey").alias("_key"))
        .distinct()
    )
    totals = order_totals(orders).join(keys, F.col("o_custkey") == F.col("_key"), "left_semi")
    joined = totals.join(
        customers.select(*_LTV_CUSTOMER), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    grouped = joined.groupBy(*_LTV_CUSTOMER).agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_spent").alias("total_spent"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )
    average = F.col("total_spent") / F.col("total_orders")
    return _ltv_columns(grouped.withColumn("avg_order_value", average), as_of)


# -- order totals kept by deltas -------------------------------------------------------------------

TOTALS_FEED = "customer_totals"
#: What the totals take from a change of an order.
_TOTALED = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", ACTION)


def total_deltas(changes: DataFrame) -> DataFrame:
    """What change rows of orders add to each customer's totals, and the dates that came and went."""
    added = F.col(ACTION) == INSERT
    sign, day = F.when(added, 1).otherwise(-1), F.col("o_orderdate")
    return changes.where("o_custkey IS NOT NULL").groupBy("o_custkey").agg(
        F.coalesce(F.sum(F.when(F.col("o_orderkey").isNotNull(), sign)), F.lit(0)).alias("more_orders"),
        F.coalesce(F.sum(F.when(F.col("o_totalprice").isNotNull(), sign)), F.lit(0)).alias("more_priced"),
        F.coalesce(F.sum(sign * F.col("o_totalprice")), F.lit(0)).alias("more_spent"),
        F.min(F.when(added, day)).alias("came_first"),
        F.max(F.when(added, day)).alias("came_last"),
        F.min(F.when(~added, day)).alias("went_first"),
        F.max(F.when(~added, day)).alias("went_last"),
    )


def changed_totals(totals: DataFrame, orders: DataFrame, deltas: DataFrame) -> DataFrame:
    """New totals of the customers in ``deltas``.

    Counts and sums are added up. A first or last date is only looked up in the orders again, by a
    semi-join, for customers who lost an order of that date.
    """
    old = totals.withColumnsRenamed({c: f"old_{c}" for c in totals.columns})
    both = deltas.join(old, F.col("o_custkey") == F.col("old_o_custkey"), "left")
    lost = (F.col("went_first") <= F.col("old_first_order_date")) | (F.col("went_last") >= F.col("old_last_order_date"))
    keys = both.where(lost).select(F.col("o_custkey").alias("_key"))
    again = (
        orders.join(keys, F.col("o_custkey") == F.col("_key"), "left_semi")
        .groupBy(F.col("o_custkey").alias("_key"))
        .agg(F.min("o_orderdate").alias("first_now"), F.max("o_orderdate").alias("last_now"))
    )
    looked_up = F.coalesce(lost, F.lit(False))
    priced = F.coalesce("old_priced_orders", F.lit(0)) + F.col("more_priced")
    spent = (F.coalesce("old_total_spent", F.lit(0)) + F.col("more_spent")).cast("decimal(22,2)")
    return both.join(again, F.col("o_custkey") == F.col("_key"), "left").select(
        "o_custkey",
        (F.coalesce("old_total_orders", F.lit(0)) + F.col("more_orders")).alias("total_orders"),
        priced.alias("priced_orders"),
        F.when(priced > 0, spent).alias("total_spent"),
        F.when(looked_up, F.col("first_now")).otherwise(F.least("old_first_order_date", "came_first")).alias("first_order_date"),
        F.when(looked_up, F.col("last_now")).otherwise(F.greatest("old_last_order_date", "came_last")).alias("last_order_date"),
    )


def refresh_customer_totals(store: TableStore) -> JobResult:
    """Bring the stored totals up to date with the orders, from the orders' change images alone."""
    feed = ChangeFeed(store, ORDERS_SILVER, TOTALS_FEED)
    feed.start(include_initial=True)
    store.recover(CUSTOMER_TOTALS)
    # Counted, then added up.
    pending = feed.pending(keep=True, columns=_TOTALED)
    try:
        if pending.restarted:
            totals = order_totals(store.read(ORDERS_SILVER)).where("o_custkey IS NOT NULL")
            store.overwrite(CUSTOMER_TOTALS, totals)
            feed.commit(pending.upto)
            return JobResult(pending.count, f"customer totals: built from {pending.count} orders")
        if not pending.count:
            return JobResult(0, "customer totals: no waiting changes")
        # Used to find blocks, to look for lost dates and to merge: one row for each changed customer.
        deltas = total_deltas(pending.rows).persist()
        try:
            source = changed_totals(store.read(CUSTOMER_TOTALS), store.read(ORDERS_SILVER), deltas)
            values = [c for c in source.columns if c != "o_custkey"]
            counts = store.merge(CUSTOMER_TOTALS, source, values, values, keys_from=deltas, offset=(TOTALS_FEED, pending.upto))
        finally:
            deltas.unpersist()
    finally:
        pending.release()
    return JobResult(counts.affected, f"customer totals: {counts.affected} customers from {pending.count} change rows")


def load_customer_ltv(
    store: TableStore,
    as_of: date = DEFAULT_AS_OF,
    lookback_days: int = LOOKBACK_DAYS,
    now: Column | None = None,
    newest: date | None = None,
) -> JobResult:
    """Refresh the affected customers from the stored totals, then deactivate the ones that went stale."""
    customers = store.read(CUSTOMER_SILVER)
    newest = newest or newest_order_date(store)
    if newest is None:
        return JobResult(0, "customer value: no cleaned orders")
    stamp = F.current_timestamp() if now is None else now
    # Used for the guard, the block list and both semi-joins. Being materialised, its real size
    # decides whether it is broadcast.
    since = window_start(newest, lookback_days)
    affected = affected_customers(orders_since(store, since), customers, since).persist()
    try:
        merged = 0
        if affected.count():
            refresh_customer_totals(store)
            totals = store.read(CUSTOMER_TOTALS)
            source = customer_ltv(customers, totals, affected, as_of, summed=True)
            values = [c for c in source.columns if c != "c_custkey"]
            merged = store.merge(
                CUSTOMER_LTV,
                source,
                update=values,
                insert=values,
                on_update={"load_timestamp": stamp},
                on_insert={"load_timestamp": stamp},
                keys_from=affected,
            ).affected
    finally:
        affected.unpersist()
    deactivated = store.update_where(
        CUSTOMER_LTV,
        stale_customers(F.lit(as_of), ACTIVE_DAYS),
        {"is_active": F.lit(False), "load_timestamp": stamp},
    )
    return JobResult(
        merged + deactivated,
        f"customer value: {merged} customers refreshed, {deactivated} deactivated,"
        f" newest order {newest}",
    )
