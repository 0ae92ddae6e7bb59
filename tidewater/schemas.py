"""Declared tables: columns, keys, storage blocks and file patterns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VarcharType,
)

BATCH_COLUMN = "_batch_id"
BLOCK_COLUMN = "key_block"
#: Block of rows without a key.
NO_KEY_BLOCK = -(2**63)
#: Keys that a bucket of a block is to hold: each is a file of its own.
BUCKET_KEYS = 2**12

KEY = LongType()
MONEY = DecimalType(12, 2)
REPORT_MONEY = DecimalType(15, 2)
CLERK_ID = DecimalType(9, 0)


@dataclass(frozen=True)
class TableSpec:
    """One table of the platform.

    ``block`` maps the key to the storage partition an upsert has to rewrite. Blocks are ranges of
    the key, so a batch of new (rising) keys touches the last few blocks, not the whole table.
    """

    layer: str
    name: str
    columns: StructType
    keys: tuple[str, ...]
    block: Callable[[], Column] | None = None
    cluster_by: tuple[str, ...] = ()
    bulk_pattern: str | None = None
    pipe_pattern: str | None = None
    #: Buckets of the key within each block, at most; 0 for tables that are written as a whole or are small.
    buckets: int = 0
    #: Whether row-level writes keep before and after images.
    feed: bool = False
    #: Column whose range is kept for each block.
    zone: str | None = None

    @property
    def narrow(self) -> bool:
        """Whether the blocks hold few keys for their buckets."""
        return getattr(self.block, "width", 2**63) < self.buckets * BUCKET_KEYS

    def stored_block(self) -> Column:
        return F.coalesce(self.block(), F.lit(NO_KEY_BLOCK).cast("bigint"))

    @property
    def partition_column(self) -> str:
        return BATCH_COLUMN if self.layer == "staging" else BLOCK_COLUMN

    @property
    def read_schema(self) -> StructType:
        """Column types as stored: text lengths are enforced on load, not by the files."""
        return StructType(
            [StructField(f.name, stored_type(f.dataType), True) for f in self.columns]
        )

    @property
    def file_columns(self) -> list[StructField]:
        """The columns a delivered file holds, in file order."""
        return [f for f in self.columns if f.name not in LINEAGE_NAMES]


def stored_type(declared: DataType) -> DataType:
    return StringType() if isinstance(declared, VarcharType) else declared


def _columns(*pairs: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in pairs])


def key_range_block(key: str, bits: int) -> Callable[[], Column]:
    """Block number of a key when every block holds at most ``2 ** bits`` consecutive keys."""

    def block() -> Column:
        return F.shiftright(F.col(key).cast("bigint"), bits)

    block.width = 2**bits
    return block


def month_block(date_column: str) -> Callable[[], Column]:
    return lambda: (F.year(date_column) * 100 + F.month(date_column)).cast("bigint")


LINEAGE = (
    ("from_source", StringType()),
    ("created_at", TimestampType()),
    ("_ingested_at", TimestampType()),
)
LINEAGE_NAMES = {name for name, _ in LINEAGE}


def _staging(name: str, keys: tuple[str, ...], bulk: str, pipe: str, *pairs) -> TableSpec:
    return TableSpec(
        "staging", name, _columns(*pairs, *LINEAGE), keys, bulk_pattern=bulk, pipe_pattern=pipe, feed=True
    )


# File name patterns are fixed values: they decide which delivered files belong to which table.
STAGING: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _staging(
            "region", ("r_regionkey",),
            r".*tpch_sf1_region.*\.csv", r".*tpch_sf1_region_.*\.csv",
            ("r_regionkey", KEY), ("r_name", VarcharType(25)), ("r_comment", VarcharType(152)),
        ),
        _staging(
            "nation", ("n_nationkey",),
            r".*tpch_sf1_nation.*\.csv", r".*tpch_sf1_nation_.*\.csv",
            ("n_nationkey", KEY), ("n_name", VarcharType(25)), ("n_regionkey", KEY),
            ("n_comment", VarcharType(152)),
        ),
        _staging(
            "customer", ("c_custkey",),
            r".*tpch_sf1_customer.*\.csv", r".*tpch_sf1_customer_.*\.csv",
            ("c_custkey", KEY), ("c_name", VarcharType(25)), ("c_address", VarcharType(40)),
            ("c_nationkey", KEY), ("c_phone", VarcharType(15)), ("c_acctbal", MONEY),
            ("c_mktsegment", VarcharType(10)), ("c_comment", VarcharType(117)),
        ),
        _staging(
            "supplier", ("s_suppkey",),
            r".*tpch_sf1_supplier.*\.csv", r".*tpch_sf1_supplier_.*\.csv",
            ("s_suppkey", KEY), ("s_name", VarcharType(25)), ("s_address", VarcharType(40)),
            ("s_nationkey", KEY), ("s_phone", VarcharType(15)), ("s_acctbal", MONEY),
            ("s_comment", VarcharType(101)),
        ),
        _staging(
            "part", ("p_partkey",),
            r".*tpch_sf1_part.csv", r".*tpch_sf1_part_.*\.csv",
            ("p_partkey", KEY), ("p_name", VarcharType(55)), ("p_mfgr", VarcharType(25)),
            ("p_brand", VarcharType(10)), ("p_type", VarcharType(25)), ("p_size", KEY),
            ("p_container", VarcharType(10)), ("p_retailprice", MONEY),
            ("p_comment", VarcharType(23)),
        ),
        _staging(
            "partsupp", ("ps_partkey", "ps_suppkey"),
            r".*tpch_sf1_partsupp.*\.csv", r".*tpch_sf1_partsupp_.*\.csv",
            ("ps_partkey", KEY), ("ps_suppkey", KEY), ("ps_availqty", KEY),
            ("ps_supplycost", MONEY), ("ps_comment", VarcharType(199)),
        ),
        _staging(
            "orders", ("o_orderkey",),
            r".*tpch_sf1_orders.*\.csv", r".*tpch_sf1_orders_.*\.csv",
            ("o_orderkey", KEY), ("o_custkey", KEY), ("o_orderstatus", VarcharType(1)),
            ("o_totalprice", MONEY), ("o_orderdate", DateType()),
            ("o_orderpriority", VarcharType(15)), ("o_clerk", VarcharType(15)),
            ("o_shippriority", KEY), ("o_comment", VarcharType(79)),
        ),
        _staging(
            "lineitem", ("l_orderkey", "l_linenumber"),
            r".*tpch_sf1_line_item_.*\.csv", r".*tpch_sf1_line_item_.*\.csv",
            ("l_orderkey", KEY), ("l_partkey", KEY), ("l_suppkey", KEY), ("l_linenumber", KEY),
            ("l_quantity", MONEY), ("l_extendedprice", MONEY), ("l_discount", MONEY),
            ("l_tax", MONEY), ("l_returnflag", VarcharType(1)), ("l_linestatus", VarcharType(1)),
            ("l_shipdate", DateType()), ("l_commitdate", DateType()),
            ("l_receiptdate", DateType()), ("l_shipinstruct", VarcharType(25)),
            ("l_shipmode", VarcharType(10)), ("l_comment", VarcharType(44)),
        ),
    )
}

ORDERS_SILVER = TableSpec(
    "analytics",
    "orders_silver",
    _columns(
        ("o_orderkey", KEY), ("o_custkey", KEY), ("o_orderstatus", VarcharType(1)),
        ("o_orderstatus_desc", VarcharType(20)), ("o_totalprice", MONEY),
        ("o_orderdate", DateType()), ("o_order_year", IntegerType()),
        ("o_order_month", IntegerType()), ("o_order_quarter", IntegerType()),
        ("o_orderpriority", VarcharType(15)), ("o_priority_rank", IntegerType()),
        ("o_clerk", VarcharType(15)), ("o_clerk_id", CLERK_ID), ("o_shippriority", KEY),
        ("o_comment", VarcharType(79)), ("source_file", VarcharType(256)),
        ("first_loaded_at", TimestampType()), ("last_updated_at", TimestampType()),
    ),
    ("o_orderkey",),
    key_range_block("o_orderkey", 23),
    ("o_orderdate", "o_custkey"),
    buckets=64,
    feed=True,
    zone="o_orderdate",
)

CUSTOMER_SILVER = TableSpec(
    "analytics",
    "customer_silver",
    _columns(
        ("c_custkey", KEY), ("c_name", VarcharType(25)), ("c_address", VarcharType(40)),
        ("c_nationkey", KEY), ("c_nation_name", VarcharType(25)), ("c_regionkey", KEY),
        ("c_region_name", VarcharType(25)), ("c_phone", VarcharType(15)), ("c_acctbal", MONEY),
        ("c_mktsegment", VarcharType(10)), ("c_comment", VarcharType(117)),
        ("load_timestamp", TimestampType()),
    ),
    ("c_custkey",),
    key_range_block("c_custkey", 22),
    ("c_region_name", "c_nation_name"),
    buckets=64,
)

LINEITEM_SILVER = TableSpec(
    "analytics",
    "lineitem_silver",
    _columns(
        ("l_orderkey", KEY), ("l_linenumber", KEY), ("l_partkey", KEY),
        ("l_part_name", VarcharType(55)), ("l_part_type", VarcharType(25)), ("l_suppkey", KEY),
        ("l_supplier_name", VarcharType(25)), ("l_quantity", MONEY), ("l_extendedprice", MONEY),
        ("l_discount", MONEY), ("l_tax", MONEY), ("l_returnflag", VarcharType(1)),
        ("l_linestatus", VarcharType(1)), ("l_shipdate", DateType()),
        ("l_commitdate", DateType()), ("l_receiptdate", DateType()),
        ("l_shipinstruct", VarcharType(25)), ("l_shipmode", VarcharType(10)),
        ("l_comment", VarcharType(44)), ("l_net_price", MONEY), ("l_final_price", MONEY),
        ("l_ship_delay_days", IntegerType()), ("load_timestamp", TimestampType()),
    ),
    ("l_orderkey", "l_linenumber"),
    key_range_block("l_orderkey", 21),
    ("l_shipdate", "l_orderkey", "l_partkey"),
    buckets=64,
)

CUSTOMER_SENSITIVE = TableSpec(
    "analytics",
    "customer_sensitive",
    _columns(
        ("c_custkey", KEY), ("c_name", VarcharType(25)), ("c_address", VarcharType(40)),
        ("c_phone", VarcharType(15)), ("c_acctbal", MONEY), ("c_nation_name", VarcharType(25)),
        ("c_region_name", VarcharType(25)), ("c_mktsegment", VarcharType(10)),
        ("email", StringType()), ("ssn_last_9", StringType()), ("phone_number", KEY),
    ),
    ("c_custkey",),
    key_range_block("c_custkey", 22),
)

CUSTOMER_RFM_SCORES = TableSpec(
    "analytics",
    "customer_rfm_scores",
    _columns(
        ("c_custkey", KEY), ("c_name", VarcharType(25)), ("last_order_date", DateType()),
        ("frequency", KEY), ("monetary", DecimalType(22, 2)), ("recency_days", IntegerType()),
    ),
    ("c_custkey",),
    key_range_block("c_custkey", 22),
)

CUSTOMER_TOTALS = TableSpec(
    "analytics",
    "customer_totals",
    _columns(
        ("o_custkey", KEY), ("total_orders", KEY), ("priced_orders", KEY),
        ("total_spent", DecimalType(22, 2)), ("first_order_date", DateType()),
        ("last_order_date", DateType()),
    ),
    ("o_custkey",),
    key_range_block("o_custkey", 22),
    buckets=64,
)

DAILY_SALES_SUMMARY = TableSpec(
    "reports",
    "daily_sales_summary",
    _columns(
        ("summary_date", DateType()), ("order_year", IntegerType()),
        ("order_month", IntegerType()), ("order_quarter", IntegerType()),
        ("total_orders", KEY), ("total_customers", KEY), ("total_revenue", REPORT_MONEY),
        ("avg_order_value", REPORT_MONEY), ("min_order_value", REPORT_MONEY),
        ("max_order_value", REPORT_MONEY), ("load_timestamp", TimestampType()),
    ),
    ("summary_date",),
    month_block("summary_date"),
    ("summary_date",),
)

DAILY_CUSTOMERS = TableSpec(
    "reports",
    "daily_customers",
    _columns(("summary_date", DateType()), ("bucket", KEY), ("customers", BinaryType())),
    ("summary_date", "bucket"),
    month_block("summary_date"),
    ("summary_date", "bucket"),
)

CUSTOMER_LTV = TableSpec(
    "reports",
    "customer_ltv",
    _columns(
        ("c_custkey", KEY), ("c_name", VarcharType(25)), ("c_nation_name", VarcharType(25)),
        ("c_region_name", VarcharType(25)), ("c_mktsegment", VarcharType(10)),
        ("total_orders", KEY), ("total_spent", REPORT_MONEY), ("avg_order_value", REPORT_MONEY),
        ("first_order_date", DateType()), ("last_order_date", DateType()),
        ("customer_tenure_days", IntegerType()), ("customer_tier", VarcharType(20)),
        ("is_active", BooleanType()), ("load_timestamp", TimestampType()),
    ),
    ("c_custkey",),
    key_range_block("c_custkey", 22),
    ("c_custkey", "c_region_name", "c_nation_name"),
    buckets=64,
)

DERIVED: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        ORDERS_SILVER,
        CUSTOMER_SILVER,
        LINEITEM_SILVER,
        CUSTOMER_SENSITIVE,
        CUSTOMER_RFM_SCORES,
        CUSTOMER_TOTALS,
        DAILY_SALES_SUMMARY,
        DAILY_CUSTOMERS,
        CUSTOMER_LTV,
    )
}
