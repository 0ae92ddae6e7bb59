"""Registered queries: every operator and job, run over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, TimestampType

from ..functions import (
    clamp_negative,
    classify_customer_revenue,
    classify_orderstatus,
    classify_priority_rank,
    register_functions,
    right_chars,
    validate_email,
    validate_phone_number,
    zero_padded,
)
from ..operators.changes import (
    ROW_ID,
    append_feed,
    newest_changes,
    table_changes,
)
from ..operators.dedup import latest_per_key
from ..operators.layout import write_on_curve
from ..operators.masking import masked
from ..operators.merge import deactivate_stale, delete_where
from ..operators.store import TableStore, write_clustered
from ..operators.versions import Files
from ..plans import analytics, gold, governance, profiling, silver
from ..plans.refresh import create_tables, ingest_all, initial_load, refresh, start_feeds
from ..schemas import (
    BATCH_COLUMN,
    CUSTOMER_LTV,
    CUSTOMER_SENSITIVE,
    CUSTOMER_SILVER,
    CUSTOMER_TOTALS,
    DAILY_CUSTOMERS,
    DAILY_SALES_SUMMARY,
    LINEITEM_SILVER,
    ORDERS_SILVER,
    STAGING,
    TableSpec,
    key_range_block,
    month_block,
)
from ..session import freed_shuffles
from ..sources.catalog import register_masked, register_tables, use_role
from ..sources.delimited import bulk_load
from ..sources.given_tables import staging_table
from ..sources.stage import staged_files
from ..streaming.feed import ChangeFeed
from ..streaming.ingest import ingest_new_files, ingest_status
from ..workspace import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = gold.DEFAULT_AS_OF
EARLY, LATE = date(2001, 2, 1), date(2001, 8, 1)


def shown(df: DataFrame) -> DataFrame:
    """The form in which results are compared: no decimals, dates or narrow integers."""
    columns: list[Column] = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double" if field.dataType.scale else "bigint")
        elif isinstance(field.dataType, DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, IntegralType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# -- inputs --------------------------------------------------------------------------------------

_cleaned: dict[tuple[str, str], TableStore] = {}
_built: set[tuple[str, str, str]] = set()


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return staging_table(spark, sf_dir, name)


def cleaned(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    """A cleaned table built from the given ones. Written once per session, as reports read it."""
    app = spark.sparkContext.applicationId
    store = _cleaned.get((app, sf_dir))
    if store is None:
        store = _cleaned[app, sf_dir] = TableStore(spark, scratch_dir(spark, "cleaned"))
    if (app, sf_dir, spec.name) not in _built:
        store.overwrite(spec, _BUILD[spec.name](spark, sf_dir, store.dealt(spec)))
        _built.add((app, sf_dir, spec.name))
    return store.read(spec)


def _stamped(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.lit("2024-06-01 00:00:00").cast("timestamp"))


def _build_orders(spark: SparkSession, sf_dir: str, partitions: int | None) -> DataFrame:
    return _stamped(silver.stored_orders(staged(spark, sf_dir, "orders"), partitions), "last_updated_at")


def _customers_from(spark: SparkSession, sf_dir: str, customer: DataFrame) -> DataFrame:
    return silver.customer_silver(
        customer,
        silver.lookup_nation(staged(spark, sf_dir, "nation")),
        silver.lookup_region(staged(spark, sf_dir, "region")),
    )


def _build_customer(spark: SparkSession, sf_dir: str, partitions: int | None) -> DataFrame:
    rows = _customers_from(spark, sf_dir, staged(spark, sf_dir, "customer"))
    return _stamped(rows, "load_timestamp")


def _build_lineitem(spark: SparkSession, sf_dir: str, partitions: int | None) -> DataFrame:
    given = (staged(spark, sf_dir, name) for name in ("lineitem", "part", "supplier"))
    return _stamped(silver.stored_lineitem(*given, partitions), "load_timestamp")


def _build_ltv(spark: SparkSession, sf_dir: str, partitions: int | None) -> DataFrame:
    customers, orders = _customers(spark, sf_dir), _orders(spark, sf_dir)
    return _stamped(gold.customer_ltv(customers, orders, as_of=AS_OF), "load_timestamp")


_BUILD = {
    "orders_silver": _build_orders,
    "customer_silver": _build_customer,
    "lineitem_silver": _build_lineitem,
    "customer_ltv": _build_ltv,
}


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir, ORDERS_SILVER)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir, CUSTOMER_SILVER)


def _lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir, LINEITEM_SILVER)


def _sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.customer_sensitive(_customers(spark, sf_dir))


def _ltv_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir, CUSTOMER_LTV).drop("load_timestamp")


# The two snapshots used for change capture (same rules as in the check SQL).


def _finish_pending(orders: DataFrame) -> DataFrame:
    pending = F.col("o_orderstatus") == "P"
    return orders.withColumns(
        {
            "o_totalprice": F.when(pending, F.col("o_totalprice") + 10)
            .otherwise(F.col("o_totalprice"))
            .cast("decimal(12,2)"),
            "o_orderstatus": F.when(pending, "F").otherwise(F.col("o_orderstatus")),
        }
    )


def _orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit(date(2001, 1, 1)))


def _orders_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")
    # Filtered before the status changes, so that finished orders are not taken for open ones.
    return _finish_pending(delete_where(staged(spark, sf_dir, "orders"), removed))


def _orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_changes(
        _orders_before(spark, sf_dir), _orders_after(spark, sf_dir), STAGING["orders"].keys
    )


def _customer_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "customer").filter("c_acctbal >= 0")


def _customer_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("c_mktsegment") == "BUILDING", (F.col("c_nationkey") + 1) % 25)
    return staged(spark, sf_dir, "customer").withColumn(
        "c_nationkey", moved.otherwise(F.col("c_nationkey"))
    )


def _lineitem_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") < F.lit(date(2000, 1, 1)))


def _lineitem_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    discount = F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_discount"))
    return (
        staged(spark, sf_dir, "lineitem")
        .filter(F.col("l_shipdate") >= F.lit(date(1999, 6, 1)))
        .withColumn("l_discount", discount.cast("decimal(12,2)"))
    )


# -- sources and incremental loading -------------------------------------------------------------


def _deliver(df: DataFrame, stage: str, name: str) -> None:
    """Put rows into the stage as delimited text, below a folder named like the delivery."""
    (
        df.write.option("header", "true")
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(f"{stage}/{name}")
    )


def _take_back(spark: SparkSession, folder: str) -> None:
    """Delivered text that has been loaded goes: it is larger than all tables built of it."""
    Files(spark, folder).delete(folder)


def _file_columns(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[f.name for f in STAGING[table].file_columns])


def csv_bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = scratch_dir(spark, "stage")
    _deliver(_file_columns(staged(spark, sf_dir, "orders"), "orders"), stage, "tpch_sf1_orders.csv")
    _deliver(_file_columns(staged(spark, sf_dir, "nation"), "nation"), stage, "tpch_sf1_nation.csv")
    loaded = bulk_load(spark, stage, STAGING["orders"], r".*tpch_sf1_orders.*\.csv")
    return shown(_file_columns(loaded, "orders"))


def csv_ragged_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt come in rows that stop after the nation, the rest with surplus fields."""
    stage = scratch_dir(spark, "stage")
    rows = _file_columns(staged(spark, sf_dir, "customer"), "customer")
    short = rows.filter("c_acctbal < 0").select("c_custkey", "c_name", "c_address", "c_nationkey")
    long = rows.filter("c_acctbal >= 0").select("*", F.lit("x").alias("x"), F.lit(1).alias("y"))
    _deliver(short, stage, "tpch_sf1_customer_1.csv")
    _deliver(long, stage, "tpch_sf1_customer_2.csv")
    store = TableStore(spark, scratch_dir(spark, "tables"))
    ingest_new_files(store, STAGING["customer"], stage).awaitTermination()
    return shown(_file_columns(store.read(STAGING["customer"]), "customer"))


def csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments with line breaks, quotes and commas, through the bulk load and the pipe."""
    stage = scratch_dir(spark, "stage")
    store = TableStore(spark, scratch_dir(spark, "tables"))
    spec = STAGING["orders"]
    comment = F.concat(F.lit('one, "two"\nthree,'), F.col("o_orderkey"), F.lit(",x"))
    orders = staged(spark, sf_dir, "orders").withColumn("o_comment", comment)
    _deliver(_file_columns(orders, "orders"), stage, "tpch_sf1_orders_1.csv")
    ingest_new_files(store, spec, stage).awaitTermination()
    loads = {"bulk": bulk_load(spark, stage, spec), "pipe": store.read(spec)}
    bulk, pipe = (
        _file_columns(df, "orders").withColumn("load", F.lit(name)) for name, df in loads.items()
    )
    return shown(bulk.unionByName(pipe))


def bulk_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bulk deliveries and a run without news: the second adds to the first."""
    stage = scratch_dir(spark, "stage")
    store = TableStore(spark, scratch_dir(spark, "tables"))
    orders = _file_columns(staged(spark, sf_dir, "orders"), "orders")
    border = F.col("o_orderdate") < F.lit(date(1998, 1, 1))
    for number, part in ((1, border), (2, ~border)):
        _deliver(orders.filter(part), stage, f"tpch_sf1_orders_{number}.csv")
        initial_load(store, stage, ["orders"])
    initial_load(store, stage, ["orders"])
    columns = [*orders.columns, BATCH_COLUMN]
    return shown(store.read_partitioned(STAGING["orders"]).select(*columns))


def pipe_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bulk load, then a pipe with a checkpoint of its own: its first batch replaces nothing."""
    bulk, later = scratch_dir(spark, "stage"), scratch_dir(spark, "stage")
    store = TableStore(spark, scratch_dir(spark, "tables"))
    orders = _file_columns(staged(spark, sf_dir, "orders"), "orders")
    border = F.col("o_orderdate") < F.lit(date(1998, 1, 1))
    _deliver(orders.filter(border), bulk, "tpch_sf1_orders_1.csv")
    _deliver(orders.filter(~border), later, "tpch_sf1_orders_1.csv")
    initial_load(store, bulk, ["orders"])
    ingest_new_files(store, STAGING["orders"], later).awaitTermination()
    columns = [*orders.columns, BATCH_COLUMN]
    return shown(store.read_partitioned(STAGING["orders"]).select(*columns))


def stage_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of order files per status; customers' files do not match the pattern."""
    stage = scratch_dir(spark, "stage")
    orders = _file_columns(staged(spark, sf_dir, "orders"), "orders")
    orders.withColumn("delivery", F.col("o_orderstatus")).write.partitionBy("delivery").csv(
        f"{stage}/tpch_sf1_orders_1.csv"
    )
    customers = _file_columns(staged(spark, sf_dir, "customer"), "customer")
    _deliver(customers, stage, "tpch_sf1_customer_1.csv")
    listed = staged_files(spark, stage, STAGING["orders"].pipe_pattern)
    return listed.select(
        F.regexp_extract("file_name", "delivery=([^/]+)", 1).alias("delivery"),
        F.col("last_modified").isNotNull().alias("has_modified"),
        (F.col("scanned_at") >= F.col("last_modified")).alias("scanned_later"),
    ).distinct()


def pipe_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries and a run without news: every file is loaded once, under its batch."""
    stage = scratch_dir(spark, "stage")
    store = TableStore(spark, scratch_dir(spark, "tables"))
    spec = STAGING["orders"]
    orders = _file_columns(staged(spark, sf_dir, "orders"), "orders")
    border = F.col("o_orderdate") < F.lit(date(1998, 1, 1))
    for number, part in ((1, border), (2, ~border)):
        _deliver(orders.filter(part), stage, f"tpch_sf1_orders_{number}.csv")
        ingest_new_files(store, spec, stage).awaitTermination()
    ingest_new_files(store, spec, stage).awaitTermination()
    columns = [f.name for f in spec.file_columns] + [BATCH_COLUMN]
    return shown(store.read_partitioned(spec).select(*columns))


def follow_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deliveries, taken up by a load that keeps running."""
    stage = scratch_dir(spark, "stage")
    store = TableStore(spark, scratch_dir(spark, "tables"))
    spec = STAGING["orders"]
    orders = _file_columns(staged(spark, sf_dir, "orders"), "orders")
    border = F.col("o_orderdate") < F.lit(date(1998, 1, 1))
    load = None
    try:
        for number, part in ((1, border), (2, ~border)):
            _deliver(orders.filter(part), stage, f"tpch_sf1_orders_{number}.csv")
            load = load or ingest_new_files(store, spec, stage, trigger={"processingTime": "1 second"})
            load.processAllAvailable()
    finally:
        if load:
            load.stop()
    columns = [f.name for f in spec.file_columns] + [BATCH_COLUMN]
    return shown(store.read_partitioned(spec).select(*columns))


def pipe_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of all eight tables in one stage, taken up by one load; a second run finds nothing new."""
    stage = scratch_dir(spark, "stage")
    store = TableStore(spark, scratch_dir(spark, "tables"))
    for name in STAGING:
        file_name = {"lineitem": "line_item"}.get(name, name)
        _deliver(_file_columns(staged(spark, sf_dir, name), name), stage, f"tpch_sf1_{file_name}_1.csv")
    for _ in range(2):
        ingest_all(store, stage)
    counted = [
        store.read_partitioned(spec).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(spec.keys[0]).alias("key_sum"),
            F.count_distinct(BATCH_COLUMN).alias("batches"),
        )
        for name, spec in STAGING.items()
    ]
    return reduce(DataFrame.union, counted)


def load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of a load that has taken up one delivery and ended."""
    stage = scratch_dir(spark, "stage")
    store = TableStore(spark, scratch_dir(spark, "tables"))
    _deliver(_file_columns(staged(spark, sf_dir, "nation"), "nation"), stage, "tpch_sf1_nation_1.csv")
    load = ingest_new_files(store, STAGING["nation"], stage)
    load.awaitTermination()
    status = ingest_status(load)
    return status.select("name", "is_active", "batch_id", F.col("new_files").isNotNull().alias("has_rows"))


def pipe_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = scratch_dir(spark, "stage")
    store = TableStore(spark, scratch_dir(spark, "tables"))
    lineitem = _file_columns(staged(spark, sf_dir, "lineitem"), "lineitem")
    _deliver(lineitem, stage, "tpch_sf1_line_item_1.csv")
    ingest_new_files(store, STAGING["lineitem"], stage).awaitTermination()
    return (
        store.read(STAGING["lineitem"])
        .groupBy(
            F.col("from_source").rlike(STAGING["lineitem"].pipe_pattern).alias("has_source"),
            F.col("created_at").isNotNull().alias("has_modified"),
            (F.col("_ingested_at") >= F.col("created_at")).alias("has_ingested"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def layout_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items laid out by ship date; a month's filter then skips files and row groups."""
    path = scratch_dir(spark, "clustered")
    write_clustered(_lineitems(spark, sf_dir), path, LINEITEM_SILVER.cluster_by)
    month = F.col("l_shipdate").between(F.lit(date(1998, 3, 1)), F.lit(date(1998, 3, 31)))
    return shown(spark.read.parquet(path).filter(month).drop("load_timestamp"))


def layout_any_key_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items laid out on a curve: a date, an order and a part filter each read a part of the files."""
    path = scratch_dir(spark, "curve")
    write_on_curve(_lineitems(spark, sf_dir), path, LINEITEM_SILVER.cluster_by)
    stored = spark.read.parquet(path).drop("load_timestamp")
    month = F.col("l_shipdate").between(F.lit(date(1998, 3, 1)), F.lit(date(1998, 3, 31)))
    filters = {"date": month, "order": F.col("l_orderkey").between(100, 200), "part": F.col("l_partkey") == 7}
    found = [stored.filter(f).withColumn("by", F.lit(name)) for name, f in filters.items()]
    return shown(reduce(DataFrame.union, found))


# -- cleaned layer -------------------------------------------------------------------------------


def orders_silver_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(silver.orders_silver(staged(spark, sf_dir, "orders")).drop("source_file"))


def customer_silver_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_customers_from(spark, sf_dir, staged(spark, sf_dir, "customer")))


def lineitem_silver_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.lineitem_silver(
        staged(spark, sf_dir, "lineitem"),
        silver.lookup_part(staged(spark, sf_dir, "part")),
        silver.lookup_supplier(staged(spark, sf_dir, "supplier")),
    )
    return shown(rows)


def lineitem_version_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = latest_per_key(
        staged(spark, sf_dir, "lineitem"), STAGING["lineitem"].keys, keep_rank=True
    )
    return shown(
        ranked.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_shipdate",
            "l_extendedprice",
            "_rank",
        )
    )


def _prepared(
    spark: SparkSession,
    sf_dir: str,
    job: silver.SilverJob,
    before: DataFrame,
    feed: DataFrame,
    lookups: tuple[str, ...] = (),
    keep_feed: bool = True,
) -> Callable[[], DataFrame]:
    """Load ``before`` in full; what is returned applies the feed and reads the cleaned table."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    for name in lookups:
        store.write_batch(STAGING[name], staged(spark, sf_dir, name), 0)
    store.write_batch(STAGING[job.staging], before, 0)
    silver.full_load(store, job)

    def merge() -> DataFrame:
        silver.apply_changes(store, job, feed, keep_feed=keep_feed)
        return shown(store.read(job.target).drop(job.stamp, "source_file"))

    return merge


def prepared_orders_merge(spark: SparkSession, sf_dir: str) -> Callable[[], DataFrame]:
    feed = _orders_feed(spark, sf_dir)
    return _prepared(spark, sf_dir, silver.ORDERS_JOB, _orders_before(spark, sf_dir), feed)


def prepared_customer_merge(spark: SparkSession, sf_dir: str) -> Callable[[], DataFrame]:
    before = _customer_before(spark, sf_dir)
    feed = table_changes(before, _customer_after(spark, sf_dir), STAGING["customer"].keys)
    return _prepared(spark, sf_dir, silver.CUSTOMER_JOB, before, feed, ("nation", "region"))


def prepared_lineitem_merge(spark: SparkSession, sf_dir: str) -> Callable[[], DataFrame]:
    feed = append_feed(_lineitem_second(spark, sf_dir), STAGING["lineitem"].keys)
    before = _lineitem_first(spark, sf_dir)
    lookups = ("part", "supplier")
    return _prepared(spark, sf_dir, silver.LINEITEM_JOB, before, feed, lookups, keep_feed=False)


def orders_cdc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared_orders_merge(spark, sf_dir)()


def orders_merge_many_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a table of narrow key blocks, so that many of them are replaced."""
    narrow = replace(ORDERS_SILVER, block=key_range_block("o_orderkey", 10))
    job = replace(silver.ORDERS_JOB, target=narrow)
    return _prepared(spark, sf_dir, job, _orders_before(spark, sf_dir), _orders_feed(spark, sf_dir))()


def customer_cdc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared_customer_merge(spark, sf_dir)()


def lineitem_cdc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared_lineitem_merge(spark, sf_dir)()


# -- change feed ---------------------------------------------------------------------------------


def orders_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _orders_feed(spark, sf_dir).drop(ROW_ID, "from_source", "created_at", "_ingested_at")
    return shown(feed)


def orders_pending_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _orders_feed(spark, sf_dir)
    return feed.groupBy("_action", "_is_update").agg(F.count(F.lit(1)).alias("pending"))


def orders_newest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = newest_changes(_orders_feed(spark, sf_dir), STAGING["orders"].keys)
    return shown(feed.select("o_orderkey", "o_comment", "_action", "created_at"))


def _fed(spark: SparkSession, sf_dir: str) -> tuple[TableStore, ChangeFeed]:
    """Stored orders of the first snapshot, a feed behind them, then deletes, an update and a new load."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    orders = STAGING["orders"]
    store.write_batch(orders, _orders_before(spark, sf_dir), 0)
    silver.full_load(store, silver.ORDERS_JOB, F.lit("2024-02-01").cast("timestamp"))
    feed = silver.ORDERS_JOB.feed(store)
    feed.start()
    store.delete_where(orders, (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW"))
    pending = F.col("o_orderstatus") == "P"
    price = (F.col("o_totalprice") + 10).cast("decimal(12,2)")
    store.update_where(orders, pending, {"o_orderstatus": F.lit("F"), "o_totalprice": price})
    later = _orders_after(spark, sf_dir).where(F.col("o_orderdate") >= F.lit(date(2001, 1, 1)))
    store.write_batch(orders, later, 3)
    return store, feed


def orders_feed_after_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table's own change feed, behind deletes, an update and a load."""
    _, feed = _fed(spark, sf_dir)
    return shown(feed.pending().rows.drop(ROW_ID, "from_source", "created_at", "_ingested_at"))


def orders_feed_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of waiting rows, as the feed reports it and by kind."""
    _, feed = _fed(spark, sf_dir)
    waiting = feed.pending()
    kinds = waiting.rows.groupBy("_action", "_is_update").agg(F.count(F.lit(1)).alias("pending"))
    return kinds.withColumn("all_pending", F.lit(waiting.count).cast("bigint"))


def merge_job_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs of the orders merge report: the second has nothing to do."""
    store, _ = _fed(spark, sf_dir)
    results = [(run, *vars(silver.merge_orders_cdc(store)).values()) for run in (1, 2)]
    return spark.createDataFrame(results, "run bigint, rows_affected bigint, message string")


def merge_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load stamps after a merge: set where a row was merged, unchanged elsewhere."""
    store, _ = _fed(spark, sf_dir)
    silver.merge_changes(store, silver.ORDERS_JOB, F.lit("2024-03-01").cast("timestamp"))
    stamp = F.date_format("last_updated_at", "yyyy-MM-dd").alias("updated_on")
    first = F.date_format("first_loaded_at", "yyyy-MM-dd").alias("first_loaded_on")
    return store.read(ORDERS_SILVER).select("o_orderkey", "o_orderstatus", stamp, first)


def write_then_read_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read by its name behind a merge that was cut off before its commit, and behind its repetition."""

    class CutOff(TableStore):
        def _commit(self, spec, versions, note):
            raise RuntimeError("cut off")

    store = TableStore(spark, scratch_dir(spark, "tables"))
    before, after = (silver.orders_silver(f(spark, sf_dir)) for f in (_orders_before, _orders_after))
    # Cleaning keeps every key, so the blocks can be found without it.
    keys = _orders_after(spark, sf_dir).select("o_orderkey")
    store.overwrite(ORDERS_SILVER, before)
    register_tables(store, [ORDERS_SILVER])
    copied = [c for c in after.columns if c != "o_orderkey"]

    def by_name(phase: str) -> DataFrame:
        rows = spark.sql(
            "SELECT o_orderstatus_desc, count(*) AS order_count, sum(o_totalprice) AS total"
            " FROM analytics.orders_silver GROUP BY o_orderstatus_desc"
        )
        # Kept at once: the next write changes what the name stands for.
        kept = shown(rows.withColumn("phase", F.lit(phase)))
        return spark.createDataFrame(kept.collect(), kept.schema)

    try:
        CutOff(spark, store.root).merge(ORDERS_SILVER, after, copied, copied, keys_from=keys)
    except RuntimeError:
        cut_off = by_name("cut off")
    store.merge(ORDERS_SILVER, after, copied, copied, keys_from=keys)
    return cut_off.union(by_name("repeated"))


def customer_ltv_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per customer kept by deltas: built once, then moved by a merge and a delete of orders."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    store.overwrite(ORDERS_SILVER, silver.orders_silver(_orders_before(spark, sf_dir)))
    gold.refresh_customer_totals(store)
    after = silver.orders_silver(_orders_after(spark, sf_dir))
    copied = [c for c in after.columns if c != "o_orderkey"]
    store.merge(ORDERS_SILVER, after, copied, copied)
    gold.refresh_customer_totals(store)
    store.delete_where(ORDERS_SILVER, (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW"))
    gold.refresh_customer_totals(store)
    return shown(store.read(CUSTOMER_TOTALS).where("total_orders > 0"))


def order_blocks_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of the newest days, from blocks chosen by the order dates kept for each."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    narrow = replace(ORDERS_SILVER, block=month_block("o_orderdate"), keys=("o_orderkey",))
    store.overwrite(narrow, _orders(spark, sf_dir))
    newest = gold.newest_order_date(store)
    since = gold.window_start(newest)
    opened = store.zones(ORDERS_SILVER).where(F.col("high") >= since.isoformat()).count()
    sales = gold.daily_sales(gold.orders_since(store, since))
    return shown(sales.withColumn("blocks_opened", F.lit(opened).cast("bigint")))


def delete_where_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete from the stored staging table; rows whose condition is NULL stay."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    store.write_batch(STAGING["orders"], staged(spark, sf_dir, "orders"), 0)
    store.delete_where(
        STAGING["orders"], (F.col("o_clerk") == "Clerk#none") | (F.col("o_totalprice") >= 400000)
    )
    return shown(_file_columns(store.read(STAGING["orders"]), "orders"))


# -- reports -------------------------------------------------------------------------------------


def daily_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return shown(gold.daily_sales(orders, gold.window_start(gold.high_water_mark(orders))))


def daily_sales_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(gold.daily_sales(_orders(spark, sf_dir)))


def daily_sales_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report loaded before and after the orders of 2001 arrive."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    for orders in (_orders_before(spark, sf_dir), staged(spark, sf_dir, "orders")):
        store.overwrite(ORDERS_SILVER, silver.orders_silver(orders))
        gold.load_daily_sales_summary(store)
    return shown(store.read(DAILY_SALES_SUMMARY).drop("load_timestamp"))


def _refreshed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit(date(2001, 7, 20)), (F.col("c_custkey") % 10).cast("int"))
    return _customers(spark, sf_dir).withColumn("load_timestamp", day.cast("timestamp"))


def _affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    since = gold.window_start(gold.high_water_mark(orders))
    return gold.affected_customers(orders, _refreshed_customers(spark, sf_dir), since)


def ltv_affected_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _affected(spark, sf_dir)


def customer_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(
        gold.customer_ltv(
            _customers(spark, sf_dir), _orders(spark, sf_dir), _affected(spark, sf_dir), AS_OF
        )
    )


def customer_ltv_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older report, then the incremental job after more orders: refresh, keep, deactivate."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    orders = _orders(spark, sf_dir)
    customers = _customers(spark, sf_dir).withColumn(
        "load_timestamp", F.lit("1990-01-01 00:00:00").cast("timestamp")
    )
    early = orders.filter(F.col("o_orderdate") < F.lit(EARLY))
    store.overwrite(CUSTOMER_LTV, gold.customer_ltv(customers, early, as_of=EARLY))
    store.overwrite(ORDERS_SILVER, orders)
    store.overwrite(CUSTOMER_SILVER, customers)
    gold.load_customer_ltv(store, LATE)
    return shown(store.read(CUSTOMER_LTV).drop("load_timestamp"))


def customer_ltv_deactivate(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _customers(spark, sf_dir)
    ltv = gold.customer_ltv(customers, _orders(spark, sf_dir), as_of=LATE)
    before = ltv.withColumn("load_timestamp", F.lit("2001-08-01").cast("timestamp"))
    after = deactivate_stale(
        before, F.lit(date(2001, 10, 1)), now=F.lit("2001-10-01").cast("timestamp")
    )
    return shown(
        after.select(
            "c_custkey",
            "last_order_date",
            "is_active",
            (F.col("load_timestamp") > F.lit("2001-09-01").cast("timestamp")).alias(
                "was_deactivated"
            ),
        )
    )


def customer_ltv_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    since = gold.window_start(gold.high_water_mark(orders))
    return shown(gold.customer_ltv_preview(_customers(spark, sf_dir), orders, since, AS_OF))


# -- analytics -----------------------------------------------------------------------------------


def customer_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(
        analytics.customer_rfm(_customers(spark, sf_dir), _orders(spark, sf_dir), AS_OF)
    )


def rfm_active_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rfm = analytics.customer_rfm(_customers(spark, sf_dir), _orders(spark, sf_dir), AS_OF)
    return shown(
        analytics.rfm_sample(rfm).select("c_custkey", "c_name", "frequency", "monetary")
    )


def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(analytics.monthly_sales(_orders(spark, sf_dir)))


def spend_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    quartiles = analytics.spend_quartiles(_orders(spark, sf_dir))
    return quartiles.select(*[F.round(c, 4).alias(c) for c in quartiles.columns])


def tier_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.tier_distribution(_ltv_now(spark, sf_dir))


def activity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.activity_flags(_ltv_now(spark, sf_dir))


def customers_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(analytics.customers_with_orders(_ltv_now(spark, sf_dir)))


# -- profiling and checks ------------------------------------------------------------------------


def customers_per_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.customers_per_country(
        staged(spark, sf_dir, "customer"), staged(spark, sf_dir, "nation")
    )


def orders_by_status_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.orders_by(_orders(spark, sf_dir), "o_orderstatus_desc", unique_keys=True)


def orders_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.orders_by(staged(spark, sf_dir, "orders"), "o_orderstatus")


def top_part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.top_part_types(_lineitems(spark, sf_dir))


def monthly_status_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(profiling.monthly_status_profile(_orders(spark, sf_dir)))


def _cleaned_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders_silver": _orders(spark, sf_dir),
        "customer_silver": _customers(spark, sf_dir),
        "lineitem_silver": _lineitems(spark, sf_dir),
    }


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: staged(spark, sf_dir, name) for name in STAGING}
    return profiling.row_counts({**tables, **_cleaned_tables(spark, sf_dir)})


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hidden = ("source_file", "last_updated_at", "load_timestamp")
    tables = {k: df.drop(*hidden) for k, df in _cleaned_tables(spark, sf_dir).items()}
    return profiling.null_counts(tables)


def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = {
        name: (staged(spark, sf_dir, name), STAGING[name].keys) for name in ("orders", "lineitem")
    }
    tables = _cleaned_tables(spark, sf_dir)
    keyed = {
        spec.name: (tables[spec.name], spec.keys)
        for spec in (ORDERS_SILVER, CUSTOMER_SILVER, LINEITEM_SILVER)
    }
    reports = {
        "daily_sales_summary": (
            gold.daily_sales(tables["orders_silver"]),
            DAILY_SALES_SUMMARY.keys,
        ),
        "customer_ltv": (_ltv_now(spark, sf_dir), CUSTOMER_LTV.keys),
    }
    return profiling.key_uniqueness({**staging, **keyed, **reports})


def load_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = profiling.load_probe(staged(spark, sf_dir, "orders"), "o_orderkey", 1000)
    return shown(probe.drop("from_source"))


def tables_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored tables queried by name."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    store.overwrite(ORDERS_SILVER, _orders(spark, sf_dir))
    register_tables(store, [ORDERS_SILVER])
    return spark.sql(
        "SELECT o_orderstatus_desc, count(*) AS order_count FROM analytics.orders_silver"
        " GROUP BY o_orderstatus_desc"
    )


def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.rule_violations(
        {
            "orders_silver": (_orders(spark, sf_dir), profiling.order_rules()),
            "lineitem_silver": (_lineitems(spark, sf_dir), profiling.lineitem_rules()),
            "customer_ltv": (_ltv_now(spark, sf_dir), profiling.ltv_rules()),
        }
    )


# -- governance ----------------------------------------------------------------------------------


def customer_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_sensitive(spark, sf_dir))


def masked_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One SQL text read by three roles."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    store.overwrite(CUSTOMER_SENSITIVE, _sensitive(spark, sf_dir))
    text = f"SELECT * FROM {register_masked(store)}"
    seen = []
    for role in ("TPCH_ADMIN", "TPCH_ANALYST", "TPCH_VIEWER"):
        use_role(spark, role)
        seen.append(spark.sql(text).withColumn("role", F.lit(role)))
    use_role(spark, "")
    return shown(reduce(DataFrame.union, seen))


def monthly_customers_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers of months and quarters, merged from stored daily bitmaps."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    orders = _orders(spark, sf_dir)
    store.overwrite(ORDERS_SILVER, orders.where(F.col("o_orderdate") < F.lit(LATE)))
    gold.load_daily_customers(store, lookback_days=None)
    newer = orders.where(F.col("o_orderdate") >= F.lit(LATE - timedelta(days=2)))
    copied = [c for c in newer.columns if c != "o_orderkey"]
    store.merge(ORDERS_SILVER, newer, copied, copied)
    gold.load_daily_customers(store, lookback_days=(date(2002, 1, 1) - LATE).days)
    bitmaps = store.read(DAILY_CUSTOMERS)
    kinds = [
        gold.distinct_customers(bitmaps, F.trunc("summary_date", kind)).withColumn("kind", F.lit(kind))
        for kind in ("month", "quarter")
    ]
    return shown(reduce(DataFrame.union, kinds))


def _masked_as(role: str) -> Query:
    return lambda spark, sf_dir: shown(masked(_sensitive(spark, sf_dir), role))


def vw_customer_public(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.customer_public(_sensitive(spark, sf_dir))


def vw_customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.customer_summary(_sensitive(spark, sf_dir))


def publish_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = governance.publish(spark, _sensitive(spark, sf_dir), scratch_dir(spark, "published"))
    counts = profiling.row_counts({v: spark.read.parquet(p) for v, p in paths.items()})
    return counts.withColumnRenamed("table_name", "view_name")


# -- functions -----------------------------------------------------------------------------------


def validate_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two roles; every third phone number is too short and every fifth address is none."""
    key = F.col("c_custkey")
    phone = F.when(key % 3 == 0, key).otherwise(key + 1_000_000_000)
    email = F.when(key % 5 == 0, "no address").otherwise(F.col("email"))
    contacts = governance.customer_sensitive(_customers(spark, sf_dir), phone)
    contacts = contacts.withColumn("email", email)
    admin, analyst = (
        governance.validate_contacts(contacts, role).withColumn("role", F.lit(role))
        for role in ("TPCH_ADMIN", "TPCH_ANALYST")
    )
    return admin.unionByName(analyst)


def sensitive_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored sensitive table through its accessor."""
    store = TableStore(spark, scratch_dir(spark, "tables"))
    store.overwrite(CUSTOMER_SILVER, _customers(spark, sf_dir))
    governance.build_customer_sensitive(store)
    return shown(governance.read_sensitive(store, "TPCH_ANALYST"))


def order_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(
        staged(spark, sf_dir, "orders").select(
            "o_orderkey",
            classify_orderstatus(F.col("o_orderstatus")).alias("status_desc"),
            classify_priority_rank(F.col("o_orderpriority")).alias("priority_rank"),
            classify_customer_revenue(F.col("o_totalprice")).alias("price_tier"),
        )
    )


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    return shown(
        staged(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.expr("classify_orderstatus(o_orderstatus)").alias("status_desc"),
            F.expr("classify_priority_rank(o_orderpriority)").alias("priority_rank"),
            F.expr("classify_customer_revenue(o_totalprice)").alias("price_tier"),
        )
    )


def customer_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(
        _sensitive(spark, sf_dir).select(
            "c_custkey",
            validate_phone_number(F.col("c_phone")).alias("is_valid_pn"),
            validate_email(F.col("email")).alias("is_valid_email"),
            right_chars(F.col("c_phone"), 4).alias("phone_end"),
            zero_padded(F.col("c_custkey"), 9).alias("padded"),
            F.abs("c_acctbal").alias("balance_size"),
            clamp_negative(F.col("c_acctbal")).alias("balance_floor"),
            F.col("phone_number").alias("random_number"),
        )
    )


def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship = F.col("l_shipdate")
    return shown(
        staged(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.trunc(ship, "month").alias("ship_month"),
            F.quarter(ship).alias("ship_quarter"),
            F.date_sub(ship, 7).alias("week_before"),
            F.datediff(F.col("l_receiptdate"), F.col("l_commitdate")).alias("delay"),
            (ship.cast("timestamp") + F.expr("INTERVAL 7 HOURS")).alias("local_time"),
        )
    )


# -- the whole chain -----------------------------------------------------------------------------

_chains: dict[tuple[str, str], TableStore] = {}


def _chained(spark: SparkSession, sf_dir: str) -> TableStore:
    """Bulk load, first run, a second wave of order files, second run. Shared by two queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _chains:
        return _chains[key]
    store = TableStore(spark, scratch_dir(spark, "tables"))
    stage, later = scratch_dir(spark, "stage"), scratch_dir(spark, "stage")
    orders = staged(spark, sf_dir, "orders")
    first = F.col("o_orderdate") < F.lit(date(2001, 1, 1))
    bulk = ("region", "nation", "supplier", "partsupp", "customer", "lineitem")
    with freed_shuffles(spark):
        for name in bulk:
            file_name = {"lineitem": "line_item_0"}.get(name, name)
            rows = _file_columns(staged(spark, sf_dir, name), name)
            _deliver(rows, stage, f"tpch_sf1_{file_name}.csv")
    create_tables(store)
    initial_load(store, stage, bulk)
    _take_back(spark, stage)
    start_feeds(store, include_initial=True)
    _deliver(_file_columns(orders.filter(first), "orders"), later, "tpch_sf1_orders_1.csv")
    part = _file_columns(staged(spark, sf_dir, "part"), "part")
    _deliver(part, later, "tpch_sf1_part_1.csv")
    refresh(store, later, AS_OF)
    for name in ("tpch_sf1_orders_1.csv", "tpch_sf1_part_1.csv"):
        _take_back(spark, f"{later}/{name}")
    second = _finish_pending(orders).filter(~first | (orders["o_orderstatus"] == "P"))
    _deliver(_file_columns(second, "orders"), later, "tpch_sf1_orders_2.csv")
    refresh(store, later, AS_OF)
    _take_back(spark, later)
    _chains[key] = store
    return store


def medallion_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_chained(spark, sf_dir).read(DAILY_SALES_SUMMARY).drop("load_timestamp"))


def medallion_customer_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_chained(spark, sf_dir).read(CUSTOMER_LTV).drop("load_timestamp"))


def queries() -> dict[str, Query]:
    named = (
        follow_incremental,
        load_status,
        pipe_all_tables,
        layout_any_key_scan,
        masked_by_name,
        monthly_customers_from_days,
        orders_feed_after_delete,
        orders_feed_pending,
        merge_job_results,
        merge_stamps,
        write_then_read_by_name,
        customer_ltv_incremental,
        order_blocks_by_date,
        csv_bulk_load,
        csv_ragged_load,
        csv_quoted_breaks,
        bulk_load_twice,
        stage_listing,
        pipe_incremental,
        pipe_new_checkpoint,
        pipe_lineage,
        layout_pruned_scan,
        orders_silver_full,
        customer_silver_full,
        lineitem_silver_full,
        lineitem_version_rank,
        orders_cdc_merge,
        orders_merge_many_blocks,
        customer_cdc_merge,
        lineitem_cdc_merge,
        orders_change_feed,
        orders_pending_count,
        orders_newest_changes,
        daily_sales_summary,
        daily_sales_history,
        daily_sales_upsert,
        ltv_affected_customers,
        customer_ltv,
        customer_ltv_merge,
        customer_ltv_deactivate,
        customer_ltv_preview,
        customer_rfm,
        rfm_active_sample,
        monthly_sales,
        spend_quartiles,
        tier_distribution,
        activity_flags,
        customers_with_orders,
        customers_per_country,
        orders_by_status_desc,
        orders_by_status,
        top_part_types,
        monthly_status_profile,
        layer_row_counts,
        null_counts,
        key_uniqueness,
        rule_violations,
        load_probe,
        tables_by_name,
        customer_sensitive,
        sensitive_stored,
        vw_customer_public,
        vw_customer_summary,
        publish_views,
        validate_contacts,
        order_functions,
        customer_functions,
        date_functions,
        sql_functions,
        medallion_daily_sales,
        medallion_customer_ltv,
    )
    return {
        **{query.__name__: query for query in named},
        "delete_where": delete_where_orders,
        "masked_admin": _masked_as("TPCH_ADMIN"),
        "masked_analyst": _masked_as("TPCH_ANALYST"),
        "masked_viewer": _masked_as("TPCH_VIEWER"),
    }
