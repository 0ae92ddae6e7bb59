"""SQL for the side-by-side check, written against the given tables.

Money is summed in exact cents or decimals and shown as double; integers are BIGINT; dates and
stamps are text. The registered queries show their results in the same way.
"""

from __future__ import annotations

AS_OF = "DATE '1998-09-02'"

# Fixed values, written here once more so that the checks do not depend on the code they check.
_STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'OPEN' WHEN 'P' THEN 'PENDING'"
    " ELSE 'UNKNOWN' END"
)
_RANK = """CAST(CASE WHEN o_orderpriority LIKE '1-URGENT%' THEN 1
                WHEN o_orderpriority LIKE '2-HIGH%' THEN 2
                WHEN o_orderpriority LIKE '3-MEDIUM%' THEN 3
                WHEN o_orderpriority LIKE '4-NOT SPECIFIED%' THEN 4
                WHEN o_orderpriority LIKE '5-LOW%' THEN 5 ELSE 9 END AS BIGINT)"""
EMAIL_HIDDEN = "***@masked.com"
PHONE_PREFIX = "XXX-XXX-"
PHONE_HIDDEN = "XXX-XXX-XXX"
SSN_HIDDEN = "***-**-****"


def _loaded_at(key: str) -> str:
    return (
        f"CASE WHEN {key} % 13 <> 0 THEN CAST(DATE '2024-01-01' + CAST({key} % 5 AS INTEGER)"
        " AS TIMESTAMP) END"
    )


def _note(kind: str, key: str) -> str:
    return (
        f"CASE WHEN {key} % 11 <> 0 THEN '{kind} \"' || CAST({key} AS VARCHAR) || '\", given' END"
    )


# -- the given tables in staging shape -----------------------------------------------------------

STAGING = {
    "stg_region": f"""
        SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name,
               {_note("region", "r_regionkey")} AS r_comment,
               {_loaded_at("r_regionkey")} AS created_at
        FROM region""",
    "stg_nation": f"""
        SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
               CAST(n_regionkey AS BIGINT) AS n_regionkey,
               {_note("nation", "n_nationkey")} AS n_comment,
               {_loaded_at("n_nationkey")} AS created_at
        FROM nation""",
    "stg_customer": f"""
        SELECT c_custkey, c_name, 'addr ' || CAST(c_custkey AS VARCHAR) AS c_address,
               CAST(c_nationkey AS BIGINT) AS c_nationkey,
               CASE WHEN c_custkey % 3 = 0 THEN '15-' || CAST(1000000 + c_custkey AS VARCHAR)
                    ELSE CAST(1000000000 + c_custkey * 7919 AS VARCHAR) END AS c_phone,
               CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment,
               {_note("customer", "c_custkey")} AS c_comment,
               {_loaded_at("c_custkey")} AS created_at
        FROM customer""",
    "stg_supplier": f"""
        SELECT s_suppkey, s_name, 'addr ' || CAST(s_suppkey AS VARCHAR) AS s_address,
               CAST(s_nationkey AS BIGINT) AS s_nationkey,
               '25-' || CAST(s_suppkey AS VARCHAR) AS s_phone,
               CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal,
               {_note("supplier", "s_suppkey")} AS s_comment,
               {_loaded_at("s_suppkey")} AS created_at
        FROM supplier""",
    "stg_part": f"""
        SELECT p_partkey, p_name, 'Maker#' || CAST(p_partkey % 5 AS VARCHAR) AS p_mfgr, p_brand,
               p_type, CAST(p_size AS BIGINT) AS p_size,
               CASE WHEN p_size > 25 THEN 'JUMBO BOX' ELSE 'SM CASE' END AS p_container,
               CAST(p_retailprice AS DECIMAL(12,2)) AS p_retailprice,
               'part ' || CAST(p_partkey AS VARCHAR) AS p_comment,
               {_loaded_at("p_partkey")} AS created_at
        FROM part""",
    "stg_orders": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
               CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    WHEN o_orderkey % 89 = 0 THEN 'Clerk#none'
                    ELSE 'Clerk#' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 9, '0')
               END AS o_clerk,
               CAST(0 AS BIGINT) AS o_shippriority,
               {_note("order", "o_orderkey")} AS o_comment,
               {_loaded_at("o_orderkey")} AS created_at
        FROM orders""",
    "stg_lineitem": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,
               CAST(l_discount AS DECIMAL(12,2)) AS l_discount,
               CAST(l_tax AS DECIMAL(12,2)) AS l_tax, l_returnflag, l_linestatus,
               CAST(l_shipdate AS DATE) AS l_shipdate,
               CAST(l_shipdate AS DATE) + CAST(l_partkey % 61 - 30 AS INTEGER) AS l_commitdate,
               CAST(l_shipdate AS DATE) + CAST(1 + l_suppkey % 30 AS INTEGER) AS l_receiptdate,
               CASE WHEN l_linenumber % 2 = 0 THEN 'NONE' ELSE 'COLLECT COD' END AS l_shipinstruct,
               CASE WHEN l_suppkey % 2 = 0 THEN 'AIR' ELSE 'RAIL' END AS l_shipmode,
               {_note("line", "l_linenumber")} AS l_comment,
               {_loaded_at("l_orderkey")} AS created_at
        FROM lineitem""",
}

LINEITEM_TIES = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,"
    " l_linestatus, l_shipdate, l_commitdate, l_receiptdate, l_shipinstruct, l_shipmode, l_comment"
)


def _ties(columns: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in columns.split(","))


def _orders_silver(source: str) -> str:
    return f"""
        SELECT o_orderkey, o_custkey, o_orderstatus,
               {_STATUS} AS o_orderstatus_desc,
               o_totalprice, o_orderdate,
               CAST(year(o_orderdate) AS BIGINT) AS o_order_year,
               CAST(month(o_orderdate) AS BIGINT) AS o_order_month,
               CAST(quarter(o_orderdate) AS BIGINT) AS o_order_quarter,
               o_orderpriority,
               {_RANK} AS o_priority_rank,
               o_clerk,
               TRY_CAST(nullif(regexp_extract(o_clerk, '[0-9]+'), '') AS BIGINT) AS o_clerk_id,
               o_shippriority, o_comment, created_at AS first_loaded_at
        FROM {source}
        QUALIFY row_number() OVER (
            PARTITION BY o_orderkey ORDER BY created_at DESC NULLS FIRST) = 1"""


def _customer_silver(source: str) -> str:
    return f"""
        SELECT c_custkey, c_name, c_address, c_nationkey, n_name AS c_nation_name,
               n_regionkey AS c_regionkey, r_name AS c_region_name, c_phone, c_acctbal,
               c_mktsegment, c_comment
        FROM {source} c
        LEFT JOIN stg_nation n ON c_nationkey = n_nationkey
        LEFT JOIN stg_region r ON n_regionkey = r_regionkey
        QUALIFY row_number() OVER (
            PARTITION BY c_custkey ORDER BY c.created_at DESC NULLS FIRST) = 1"""


def _lineitem_silver(source: str) -> str:
    return f"""
        SELECT l_orderkey, l_linenumber, l_partkey, p_name AS l_part_name, p_type AS l_part_type,
               l_suppkey, s_name AS l_supplier_name, l_quantity, l_extendedprice, l_discount,
               l_tax, l_returnflag, l_linestatus, l_shipdate, l_commitdate, l_receiptdate,
               l_shipinstruct, l_shipmode, l_comment,
               CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(12,2)) AS l_net_price,
               CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(24,4)) * (1 + l_tax)
                    AS DECIMAL(12,2)) AS l_final_price,
               CAST(CASE WHEN l_receiptdate - l_commitdate < 0 THEN 0
                    ELSE l_receiptdate - l_commitdate END AS BIGINT) AS l_ship_delay_days
        FROM {source} l
        LEFT JOIN stg_part ON l_partkey = p_partkey
        LEFT JOIN stg_supplier ON l_suppkey = s_suppkey
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l.created_at DESC NULLS FIRST, {_ties(LINEITEM_TIES)}) = 1"""


SILVER = {
    "orders_silver": _orders_silver("stg_orders"),
    "customer_silver": _customer_silver("stg_customer"),
    "lineitem_silver": _lineitem_silver("stg_lineitem"),
}

# How each typed column is shown.
_MONEY = {
    "o_totalprice", "c_acctbal", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_net_price", "l_final_price", "total_spent", "total_revenue", "avg_order_value",
    "min_order_value", "max_order_value", "monetary", "p_retailprice", "s_acctbal",
}
_DATES = {
    "o_orderdate", "l_shipdate", "l_commitdate", "l_receiptdate", "summary_date",
    "first_order_date", "last_order_date",
}
_STAMPS = {"first_loaded_at", "created_at"}


def _show(columns: str) -> str:
    shown = []
    for column in (c.strip() for c in columns.split(",")):
        if column in _MONEY:
            shown.append(f"CAST({column} AS DOUBLE) AS {column}")
        elif column in _DATES:
            shown.append(f"strftime({column}, '%Y-%m-%d') AS {column}")
        elif column in _STAMPS:
            shown.append(f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}")
        else:
            shown.append(column)
    return ", ".join(shown)


ORDERS_FILE = (
    "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_clerk,"
    " o_shippriority, o_comment"
)
CUSTOMER_FILE = (
    "c_custkey, c_name, c_address, c_nationkey, c_phone, c_acctbal, c_mktsegment, c_comment"
)
ORDERS_SILVER = (
    "o_orderkey, o_custkey, o_orderstatus, o_orderstatus_desc, o_totalprice, o_orderdate,"
    " o_order_year, o_order_month, o_order_quarter, o_orderpriority, o_priority_rank, o_clerk,"
    " o_clerk_id, o_shippriority, o_comment, first_loaded_at"
)
CUSTOMER_SILVER = (
    "c_custkey, c_name, c_address, c_nationkey, c_nation_name, c_regionkey, c_region_name,"
    " c_phone, c_acctbal, c_mktsegment, c_comment"
)
LINEITEM_SILVER = (
    "l_orderkey, l_linenumber, l_partkey, l_part_name, l_part_type, l_suppkey, l_supplier_name,"
    " l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,"
    " l_commitdate, l_receiptdate, l_shipinstruct, l_shipmode, l_comment, l_net_price,"
    " l_final_price, l_ship_delay_days"
)
DAILY = (
    "summary_date, order_year, order_month, order_quarter, total_orders, total_customers,"
    " total_revenue, avg_order_value, min_order_value, max_order_value"
)
LTV = (
    "c_custkey, c_name, c_nation_name, c_region_name, c_mktsegment, total_orders, total_spent,"
    " avg_order_value, first_order_date, last_order_date, customer_tenure_days, customer_tier,"
    " is_active"
)

# -- reports -------------------------------------------------------------------------------------

_CENTS = "CAST(o_totalprice * 100 AS BIGINT)"


def _average(total_cents: str, count: str, digits: int = 2) -> str:
    """Mean in currency units, rounded half up to ``digits``, from exact integer cents."""
    scale = 10 ** (digits - 2)
    return (
        f"CAST((2 * {total_cents} * {scale} + {count}) // (2 * {count}) AS DOUBLE) / {10 ** digits}"
    )


def _daily(orders: str, since: str) -> str:
    return f"""
        SELECT o_orderdate AS summary_date,
               CAST(year(o_orderdate) AS BIGINT) AS order_year,
               CAST(month(o_orderdate) AS BIGINT) AS order_month,
               CAST(quarter(o_orderdate) AS BIGINT) AS order_quarter,
               count(DISTINCT o_orderkey) AS total_orders,
               count(DISTINCT o_custkey) AS total_customers,
               sum(o_totalprice) AS total_revenue,
               {_average(f"sum({_CENTS})", "count(o_totalprice)")} AS avg_order_value,
               min(o_totalprice) AS min_order_value, max(o_totalprice) AS max_order_value
        FROM {orders}
        WHERE o_orderdate >= {since}
        GROUP BY ALL"""


def _tier(total: str) -> str:
    return f"""CASE WHEN {total} >= 500000 THEN 'VIP' WHEN {total} >= 100000 THEN 'GOLD'
                    WHEN {total} >= 10000 THEN 'SILVER' ELSE 'STANDARD' END"""


def _ltv(customers: str, orders: str, as_of: str, keys: str | None = None) -> str:
    restrict = f"WHERE c_custkey IN (SELECT c_custkey FROM {keys})" if keys else ""
    return f"""
        SELECT c_custkey, c_name, c_nation_name, c_region_name, c_mktsegment,
               count(DISTINCT o_orderkey) AS total_orders, sum(o_totalprice) AS total_spent,
               {_average(f"sum({_CENTS})", "count(o_totalprice)")} AS avg_order_value,
               min(o_orderdate) AS first_order_date, max(o_orderdate) AS last_order_date,
               CAST({as_of} - min(o_orderdate) AS BIGINT) AS customer_tenure_days,
               {_tier("sum(o_totalprice)")} AS customer_tier,
               coalesce(max(o_orderdate) >= {as_of} - 90, FALSE) AS is_active
        FROM {customers} LEFT JOIN {orders} ON c_custkey = o_custkey
        {restrict}
        GROUP BY c_custkey, c_name, c_nation_name, c_region_name, c_mktsegment"""


_NEWEST = "(SELECT max(o_orderdate) FROM orders_silver)"
_WINDOW = f"({_NEWEST} - 7)"

_ALL = {**STAGING, **SILVER}


def _with(extra: dict[str, str], body: str, base: dict[str, str] | None = None) -> str:
    """A statement with only the named parts it needs, in order."""
    parts = {**(_ALL if base is None else base), **extra}
    needed: set[str] = set()
    text = [body]
    while text:
        piece = text.pop()
        for name, sql in parts.items():
            if name in piece and name not in needed:
                needed.add(name)
                text.append(sql)
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items() if name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


# -- snapshots for change capture ----------------------------------------------------------------

# Orders: the first snapshot lacks the orders of 2001. Until the second one, pending orders finish
# at a price 10.00 higher and open orders of the lowest priority are removed.
ORDERS_BEFORE = "SELECT * FROM stg_orders WHERE o_orderdate < DATE '2001-01-01'"
ORDERS_AFTER = """
    SELECT * REPLACE (
        CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
        CAST(CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 10 ELSE o_totalprice END
             AS DECIMAL(12,2)) AS o_totalprice)
    FROM stg_orders
    WHERE NOT (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')"""
# Customers: those with a negative balance are new in the second snapshot; the BUILDING segment
# moves one nation further.
CUSTOMER_BEFORE = "SELECT * FROM stg_customer WHERE c_acctbal >= 0"
CUSTOMER_AFTER = """
    SELECT * REPLACE (
        CASE WHEN c_mktsegment = 'BUILDING' THEN (c_nationkey + 1) % 25 ELSE c_nationkey END
            AS c_nationkey)
    FROM stg_customer"""
# Line items: a second delivery holds everything shipped from mid-1999 on, returns at no discount.
LINEITEM_FIRST = "SELECT * FROM stg_lineitem WHERE l_shipdate < DATE '2000-01-01'"
LINEITEM_SECOND = """
    SELECT * REPLACE (
        CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_discount END AS DECIMAL(12,2))
            AS l_discount)
    FROM stg_lineitem WHERE l_shipdate >= DATE '1999-06-01'"""

_CHANGES = {
    "before_orders": ORDERS_BEFORE,
    "after_orders": ORDERS_AFTER,
    "orders_changes": f"""
        SELECT {ORDERS_FILE}, created_at, 'DELETE' AS _action,
               o_orderkey IN (SELECT o_orderkey FROM after_orders) AS _is_update
        FROM (SELECT * FROM before_orders EXCEPT ALL SELECT * FROM after_orders)
        UNION ALL
        SELECT {ORDERS_FILE}, created_at, 'INSERT' AS _action,
               o_orderkey IN (SELECT o_orderkey FROM before_orders) AS _is_update
        FROM (SELECT * FROM after_orders EXCEPT ALL SELECT * FROM before_orders)""",
}


def _merge_expectation(silver: str, columns: str, keys: str, before: str, after: str) -> dict:
    """Cleaned rows of the second snapshot plus earlier rows it no longer holds."""
    build = {
        "orders": _orders_silver,
        "customer": _customer_silver,
        "lineitem": _lineitem_silver,
    }[silver]
    condition = " AND ".join(f"b.{k} = a.{k}" for k in keys.split(", "))
    return {
        "snap_before": before,
        "snap_after": after,
        "clean_before": build("snap_before"),
        "clean_after": build("snap_after"),
        "merged": f"""
            SELECT {columns} FROM clean_after
            UNION ALL
            SELECT {columns} FROM clean_before b
            WHERE NOT EXISTS (SELECT 1 FROM clean_after a WHERE {condition})""",
    }


# -- parts shared by several checks --------------------------------------------------------------

_REFRESHED = {
    # Refresh days are spread over the key so that only some customers count as refreshed.
    "spread_customers": """
        SELECT *, DATE '2001-07-20' + CAST(c_custkey % 10 AS INTEGER) AS refreshed
        FROM customer_silver""",
    "affected_keys": f"""
        SELECT o_custkey AS c_custkey FROM orders_silver WHERE o_orderdate >= {_WINDOW}
        UNION
        SELECT c_custkey FROM spread_customers WHERE refreshed >= {_WINDOW}""",
}
_SENSITIVE = {
    "sensitive": """
        SELECT c_custkey, c_name, c_address, c_phone, c_acctbal, c_nation_name, c_region_name,
               c_mktsegment, 'customer_' || CAST(c_custkey AS VARCHAR) || '@company.com' AS email,
               lpad(CAST(abs((CAST(c_custkey AS HUGEINT) * 123456789) % 1000000000) AS VARCHAR),
                    9, '0') AS ssn_last_9,
               100000000 + CAST('0x' || substr(md5('0:' || CAST(c_custkey AS VARCHAR)), 1, 15)
                    AS BIGINT) % 900000000 AS phone_number
        FROM customer_silver""",
}
_SENSITIVE_PLAIN = (
    "c_custkey, c_name, c_address, c_phone, c_acctbal, c_nation_name, c_region_name, c_mktsegment"
)
_LTV_NOW = {"ltv": _ltv("customer_silver", "orders_silver", AS_OF)}
_LATE = "DATE '2001-08-01'"
_EARLY = "DATE '2001-02-01'"


def _counts(pairs: list[tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in pairs
    )


def _null_counts(tables: dict[str, tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c.strip()}' AS column_name,"
        f" count(*) - count({c.strip()}) AS null_count FROM {source}"
        for name, (source, columns) in tables.items()
        for c in columns.split(",")
    )


def _uniqueness(tables: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS duplicate_keys,
            CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
            FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys} HAVING count(*) > 1)"""
        for name, source, keys in tables
    )


def _violations(rules: list[tuple[str, str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule,"
        f" count(*) FILTER (WHERE {bad}) AS violations FROM {source}"
        for table, source, rule, bad in rules
    )


def oracle_sql() -> dict[str, str]:
    """Check statement per registered query."""
    return {
        # -- sources and incremental loading
        "csv_bulk_load": _with({}, f"SELECT {_show(ORDERS_FILE)} FROM stg_orders"),
        "csv_ragged_load": _with(
            {},
            """SELECT c_custkey, c_name, c_address, c_nationkey,
                      CASE WHEN c_acctbal >= 0 THEN c_phone END AS c_phone,
                      CAST(CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS DOUBLE) AS c_acctbal,
                      CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment,
                      CASE WHEN c_acctbal >= 0 THEN c_comment END AS c_comment
               FROM stg_customer""",
        ),
        "csv_quoted_breaks": _with(
            {
                "broken": """
                    SELECT * REPLACE ('one, "two"' || chr(10) || 'three,' || o_orderkey || ',x'
                                      AS o_comment)
                    FROM stg_orders"""
            },
            f"""SELECT {_show(ORDERS_FILE)}, 'bulk' AS load FROM broken
                UNION ALL SELECT {_show(ORDERS_FILE)}, 'pipe' AS load FROM broken""",
        ),
        "stage_listing": _with(
            {},
            """SELECT DISTINCT o_orderstatus AS delivery, TRUE AS has_modified,
                      TRUE AS scanned_later FROM stg_orders""",
        ),
        **{
            name: _with(
                {},
                f"""SELECT {_show(ORDERS_FILE)},
                           CAST(CASE WHEN o_orderdate < DATE '1998-01-01' THEN 0 ELSE 1 END
                                AS BIGINT) AS _batch_id
                    FROM stg_orders""",
            )
            for name in ("pipe_incremental", "bulk_load_twice", "pipe_new_checkpoint", "follow_incremental")
        },
        "pipe_lineage": _with(
            {},
            """SELECT TRUE AS has_source, TRUE AS has_modified, TRUE AS has_ingested,
                      count(*) AS row_count FROM stg_lineitem""",
        ),
        "layout_pruned_scan": _with(
            {},
            f"""SELECT {_show(LINEITEM_SILVER)} FROM lineitem_silver
                WHERE l_shipdate >= DATE '1998-03-01' AND l_shipdate < DATE '1998-04-01'""",
        ),
        "layout_any_key_scan": _with(
            {},
            "\nUNION ALL ".join(
                f"SELECT {_show(LINEITEM_SILVER)}, '{name}' AS by FROM lineitem_silver WHERE {condition}"
                for name, condition in (
                    ("date", "l_shipdate >= DATE '1998-03-01' AND l_shipdate < DATE '1998-04-01'"),
                    ("order", "l_orderkey BETWEEN 100 AND 200"),
                    ("part", "l_partkey = 7"),
                )
            ),
        ),
        "monthly_customers_from_days": _with(
            {},
            "\nUNION ALL ".join(
                f"SELECT strftime(date_trunc('{kind}', o_orderdate), '%Y-%m-%d') AS period,"
                f" count(DISTINCT o_custkey) AS total_customers, '{kind}' AS kind"
                " FROM orders_silver GROUP BY ALL"
                for kind in ("month", "quarter")
            ),
        ),
        "masked_by_name": _with(
            _SENSITIVE,
            rf"""SELECT {_show(_SENSITIVE_PLAIN)}, email, ssn_last_9,
                        CAST(phone_number AS VARCHAR) AS phone_number, 'TPCH_ADMIN' AS role FROM sensitive
                 UNION ALL
                 SELECT {_show(_SENSITIVE_PLAIN)},
                        regexp_replace(email, '(^[^@]{{2}})[^@]+', '\1***'), '{SSN_HIDDEN}',
                        '{PHONE_PREFIX}' || right(CAST(phone_number AS VARCHAR), 4), 'TPCH_ANALYST'
                 FROM sensitive
                 UNION ALL
                 SELECT {_show(_SENSITIVE_PLAIN)}, '{EMAIL_HIDDEN}', '{SSN_HIDDEN}', '{PHONE_HIDDEN}',
                        'TPCH_VIEWER' FROM sensitive""",
        ),
        # -- cleaned layer
        "orders_silver_full": _with({}, f"SELECT {_show(ORDERS_SILVER)} FROM orders_silver"),
        "customer_silver_full": _with({}, f"SELECT {_show(CUSTOMER_SILVER)} FROM customer_silver"),
        "lineitem_silver_full": _with({}, f"SELECT {_show(LINEITEM_SILVER)} FROM lineitem_silver"),
        "lineitem_version_rank": _with(
            {},
            f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                       strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
                       CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
                       row_number() OVER (
                           PARTITION BY l_orderkey, l_linenumber
                           ORDER BY created_at DESC NULLS FIRST, {_ties(LINEITEM_TIES)}) AS _rank
                FROM stg_lineitem QUALIFY _rank = 1""",
        ),
        **{
            name: _with(
                _merge_expectation(
                    "orders", ORDERS_SILVER, "o_orderkey", ORDERS_BEFORE, ORDERS_AFTER
                ),
                f"SELECT {_show(ORDERS_SILVER)} FROM merged",
            )
            for name in ("orders_cdc_merge", "orders_merge_many_blocks")
        },
        "customer_cdc_merge": _with(
            _merge_expectation(
                "customer", CUSTOMER_SILVER, "c_custkey", CUSTOMER_BEFORE, CUSTOMER_AFTER
            ),
            f"SELECT {_show(CUSTOMER_SILVER)} FROM merged",
        ),
        "lineitem_cdc_merge": _with(
            _merge_expectation(
                "lineitem",
                LINEITEM_SILVER,
                "l_orderkey, l_linenumber",
                LINEITEM_FIRST,
                LINEITEM_SECOND,
            ),
            f"SELECT {_show(LINEITEM_SILVER)} FROM merged",
        ),
        # -- change feed
        **{
            name: _with(
                _CHANGES,
                f"SELECT {_show(ORDERS_FILE)}, _action, _is_update FROM orders_changes",
            )
            for name in ("orders_change_feed", "orders_feed_after_delete")
        },
        "orders_feed_pending": _with(
            _CHANGES,
            """SELECT _action, _is_update, count(*) AS pending,
                      (SELECT count(*) FROM orders_changes) AS all_pending
               FROM orders_changes GROUP BY ALL""",
        ),
        "merge_job_results": _with(
            _CHANGES,
            """SELECT CAST(1 AS BIGINT) AS run, count(*) FILTER (WHERE _action = 'INSERT') AS rows_affected,
                      'orders_silver: ' || count(*) FILTER (WHERE _action = 'INSERT')
                      || ' rows affected from ' || count(*) || ' change rows' AS message
               FROM orders_changes
               UNION ALL SELECT 2, 0, 'orders_silver: no waiting changes'""",
        ),
        "merge_stamps": _with(
            _CHANGES,
            """SELECT o_orderkey, o_orderstatus, '2024-03-01' AS updated_on,
                      strftime(created_at, '%Y-%m-%d') AS first_loaded_on
               FROM orders_changes WHERE _action = 'INSERT'
               UNION ALL
               SELECT o_orderkey, o_orderstatus, '2024-02-01',
                      strftime(created_at, '%Y-%m-%d')
               FROM before_orders
               WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_changes WHERE _action = 'INSERT')""",
        ),
        "pipe_all_tables": _with(
            {},
            "\nUNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST(sum({key}) AS BIGINT) AS key_sum,"
                f" CAST(1 AS BIGINT) AS batches FROM {source}"
                for name, key, source in (
                    ("region", "r_regionkey", "region"),
                    ("nation", "n_nationkey", "nation"),
                    ("customer", "c_custkey", "customer"),
                    ("supplier", "s_suppkey", "supplier"),
                    ("part", "p_partkey", "part"),
                    ("partsupp", "l_partkey", "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)"),
                    ("orders", "o_orderkey", "orders"),
                    ("lineitem", "l_orderkey", "lineitem"),
                )
            ),
        ),
        "load_status": _with(
            {},
            "SELECT 'ingest_nation' AS name, FALSE AS is_active, CAST(0 AS BIGINT) AS batch_id, TRUE AS has_rows",
        ),
        "write_then_read_by_name": _with(
            _merge_expectation("orders", ORDERS_SILVER, "o_orderkey", ORDERS_BEFORE, ORDERS_AFTER),
            """SELECT o_orderstatus_desc, count(*) AS order_count,
                      CAST(sum(o_totalprice) AS DOUBLE) AS total, 'cut off' AS phase
               FROM clean_before GROUP BY ALL
               UNION ALL
               SELECT o_orderstatus_desc, count(*), CAST(sum(o_totalprice) AS DOUBLE), 'repeated'
               FROM merged GROUP BY ALL""",
        ),
        "customer_ltv_incremental": _with(
            _merge_expectation("orders", ORDERS_SILVER, "o_orderkey", ORDERS_BEFORE, ORDERS_AFTER),
            """SELECT o_custkey, count(*) AS total_orders, count(o_totalprice) AS priced_orders,
                      CAST(sum(o_totalprice) AS DOUBLE) AS total_spent,
                      strftime(min(o_orderdate), '%Y-%m-%d') AS first_order_date,
                      strftime(max(o_orderdate), '%Y-%m-%d') AS last_order_date
               FROM merged WHERE NOT (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')
               GROUP BY o_custkey""",
        ),
        "order_blocks_by_date": _with(
            {"daily": _daily("orders_silver", _WINDOW)},
            f"""SELECT {_show(DAILY)},
                       (SELECT count(DISTINCT year(o_orderdate) * 100 + month(o_orderdate))
                        FROM orders_silver WHERE o_orderdate >= {_WINDOW}) AS blocks_opened
                FROM daily""",
        ),
        "orders_pending_count": _with(
            _CHANGES,
            """SELECT _action, _is_update, count(*) AS pending FROM orders_changes
               GROUP BY ALL""",
        ),
        "orders_newest_changes": _with(
            _CHANGES,
            """SELECT o_orderkey, o_comment, _action,
                      strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
               FROM orders_changes WHERE created_at IS NOT NULL""",
        ),
        "delete_where": _with(
            {},
            f"""SELECT {_show(ORDERS_FILE)} FROM stg_orders
                WHERE NOT coalesce(o_clerk = 'Clerk#none' OR o_totalprice >= 400000, FALSE)""",
        ),
        # -- reports
        "daily_sales_summary": _with(
            {"daily": _daily("orders_silver", _WINDOW)}, f"SELECT {_show(DAILY)} FROM daily"
        ),
        "daily_sales_history": _with(
            {"daily": _daily("orders_silver", "DATE '1900-01-01'")},
            f"SELECT {_show(DAILY)} FROM daily",
        ),
        "daily_sales_upsert": _with(
            {
                "before_orders": ORDERS_BEFORE,
                "clean_before": _orders_silver("before_orders"),
                "daily_before": _daily(
                    "clean_before", "((SELECT max(o_orderdate) FROM clean_before) - 7)"
                ),
                "daily_after": _daily("orders_silver", _WINDOW),
            },
            f"""SELECT {_show(DAILY)} FROM daily_after
                UNION ALL
                SELECT {_show(DAILY)} FROM daily_before
                WHERE summary_date NOT IN (SELECT summary_date FROM daily_after)""",
        ),
        "ltv_affected_customers": _with(_REFRESHED, "SELECT c_custkey FROM affected_keys"),
        "customer_ltv": _with(
            {
                **_REFRESHED,
                "ltv": _ltv("customer_silver", "orders_silver", AS_OF, "affected_keys"),
            },
            f"SELECT {_show(LTV)} FROM ltv",
        ),
        "customer_ltv_merge": _with(
            {
                "early_orders": f"SELECT * FROM orders_silver WHERE o_orderdate < {_EARLY}",
                "ltv_early": _ltv("customer_silver", "early_orders", _EARLY),
                "recent_keys": f"""SELECT o_custkey AS c_custkey FROM orders_silver
                                   WHERE o_orderdate >= {_WINDOW}""",
                "ltv_late": _ltv("customer_silver", "orders_silver", _LATE, "recent_keys"),
            },
            f"""SELECT {_show(LTV)} FROM ltv_late
                UNION ALL
                SELECT {_show(LTV.replace(", is_active", ""))},
                       is_active AND NOT coalesce(last_order_date < {_LATE} - 90, FALSE) AS is_active
                FROM ltv_early WHERE c_custkey NOT IN (SELECT c_custkey FROM ltv_late)""",
        ),
        "customer_ltv_deactivate": _with(
            {"ltv": _ltv("customer_silver", "orders_silver", _LATE)},
            f"""SELECT c_custkey, strftime(last_order_date, '%Y-%m-%d') AS last_order_date,
                       is_active AND NOT (last_order_date < DATE '2001-10-01' - 90) AS is_active,
                       is_active AND last_order_date < DATE '2001-10-01' - 90 AS was_deactivated
                FROM ltv""",
        ),
        "customer_ltv_preview": _with(
            {
                "recent_keys": f"""SELECT o_custkey AS c_custkey FROM orders_silver
                                   WHERE o_orderdate >= {_WINDOW}""",
                "ltv": _ltv("customer_silver", "orders_silver", AS_OF, "recent_keys"),
            },
            f"SELECT {_show(LTV)} FROM ltv",
        ),
        # -- analytics
        "customer_rfm": _with(
            {},
            f"""SELECT c_custkey, c_name,
                       strftime(max(o_orderdate), '%Y-%m-%d') AS last_order_date,
                       count(o_orderkey) AS frequency,
                       CAST(sum(o_totalprice) AS DOUBLE) AS monetary,
                       CAST({AS_OF} - max(o_orderdate) AS BIGINT) AS recency_days
                FROM customer_silver LEFT JOIN orders_silver ON c_custkey = o_custkey
                GROUP BY c_custkey, c_name""",
        ),
        "rfm_active_sample": _with(
            {},
            """SELECT c_custkey, c_name, count(o_orderkey) AS frequency,
                      CAST(sum(o_totalprice) AS DOUBLE) AS monetary
               FROM customer_silver LEFT JOIN orders_silver ON c_custkey = o_custkey
               GROUP BY c_custkey, c_name HAVING count(o_orderkey) > 0
               ORDER BY c_custkey LIMIT 10""",
        ),
        "monthly_sales": _with(
            {},
            f"""SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
                       count(o_orderkey) AS order_count,
                       CAST(sum(o_totalprice) AS DOUBLE) AS total_revenue,
                       {_average(f"sum({_CENTS})", "count(o_totalprice)", 6)} AS avg_order_value
                FROM orders_silver GROUP BY 1""",
        ),
        "spend_quartiles": _with(
            {},
            """SELECT round(quantile_cont(spend, 0.25), 4) AS p1,
                      round(quantile_cont(spend, 0.5), 4) AS p2,
                      round(quantile_cont(spend, 0.75), 4) AS p3
               FROM (SELECT CAST(sum(o_totalprice) AS DOUBLE) AS spend
                     FROM orders_silver GROUP BY o_custkey)""",
        ),
        "tier_distribution": _with(
            _LTV_NOW, "SELECT customer_tier, count(*) AS customers FROM ltv GROUP BY 1"
        ),
        "activity_flags": _with(_LTV_NOW, "SELECT DISTINCT is_active FROM ltv"),
        "customers_with_orders": _with(
            _LTV_NOW, f"SELECT {_show(LTV)} FROM ltv WHERE total_orders > 0"
        ),
        # -- profiling and checks
        "customers_per_country": _with(
            {},
            """SELECT n_name AS country, count(DISTINCT c_custkey) AS customer_count
               FROM stg_customer JOIN stg_nation ON c_nationkey = n_nationkey GROUP BY 1""",
        ),
        "orders_by_status_desc": _with(
            {},
            """SELECT o_orderstatus_desc, count(DISTINCT o_orderkey) AS order_count
               FROM orders_silver GROUP BY 1""",
        ),
        "orders_by_status": _with(
            {},
            """SELECT o_orderstatus, count(DISTINCT o_orderkey) AS order_count
               FROM stg_orders GROUP BY 1""",
        ),
        "top_part_types": _with(
            {},
            """SELECT l_part_type, count(DISTINCT l_orderkey) AS order_count
               FROM lineitem_silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        ),
        "monthly_status_profile": _with(
            {},
            f"""SELECT o_order_year, o_order_month, o_orderstatus_desc, count(*) AS total_orders,
                       CAST(sum(o_totalprice) AS DOUBLE) AS total_revenue,
                       {_average(f"sum({_CENTS})", "count(o_totalprice)", 6)} AS avg_order_value,
                       count(DISTINCT o_custkey) AS unique_customers
                FROM orders_silver WHERE o_orderdate >= DATE '1995-01-01'
                GROUP BY 1, 2, 3""",
        ),
        "layer_row_counts": _with(
            {},
            _counts(
                [
                    ("region", "region"), ("nation", "nation"), ("customer", "customer"),
                    ("supplier", "supplier"), ("part", "part"), ("orders", "orders"),
                    ("lineitem", "lineitem"),
                    ("partsupp", "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)"),
                    ("orders_silver", "orders_silver"), ("customer_silver", "customer_silver"),
                    ("lineitem_silver", "lineitem_silver"),
                ]
            ),
        ),
        "null_counts": _with(
            {},
            _null_counts(
                {
                    "orders_silver": ("orders_silver", ORDERS_SILVER),
                    "customer_silver": ("customer_silver", CUSTOMER_SILVER),
                    "lineitem_silver": ("lineitem_silver", LINEITEM_SILVER),
                }
            ),
        ),
        "load_probe": _with(
            {},
            f"SELECT {_show('o_orderkey, created_at')} FROM stg_orders WHERE o_orderkey >= 1000",
        ),
        "tables_by_name": _with(
            {},
            """SELECT o_orderstatus_desc, count(*) AS order_count FROM orders_silver
               GROUP BY 1""",
        ),
        "key_uniqueness": _with(
            {**_LTV_NOW, "daily": _daily("orders_silver", "DATE '1900-01-01'")},
            _uniqueness(
                [
                    ("orders", "stg_orders", "o_orderkey"),
                    ("lineitem", "stg_lineitem", "l_orderkey, l_linenumber"),
                    ("orders_silver", "orders_silver", "o_orderkey"),
                    ("customer_silver", "customer_silver", "c_custkey"),
                    ("lineitem_silver", "lineitem_silver", "l_orderkey, l_linenumber"),
                    ("daily_sales_summary", "daily", "summary_date"),
                    ("customer_ltv", "ltv", "c_custkey"),
                ]
            ),
        ),
        "rule_violations": _with(
            _LTV_NOW,
            _violations(
                [
                    ("orders_silver", "orders_silver", "order status description in domain",
                     "o_orderstatus_desc NOT IN ('FINISHED', 'OPEN', 'PENDING', 'UNKNOWN')"),
                    ("orders_silver", "orders_silver", "order priority rank in domain",
                     "o_priority_rank NOT IN (1, 2, 3, 4, 5, 9)"),
                    ("orders_silver", "orders_silver", "order date parts agree with date",
                     "o_order_year <> year(o_orderdate) OR o_order_month <> month(o_orderdate)"
                     " OR o_order_quarter <> quarter(o_orderdate)"),
                    ("lineitem_silver", "lineitem_silver", "ship delay not negative",
                     "l_ship_delay_days < 0"),
                    ("lineitem_silver", "lineitem_silver", "net price not above extended price",
                     "l_net_price > l_extendedprice"),
                    ("lineitem_silver", "lineitem_silver", "final price not below net price",
                     "l_final_price < l_net_price"),
                    ("customer_ltv", "ltv", "customer tier in domain",
                     "customer_tier NOT IN ('VIP', 'GOLD', 'SILVER', 'STANDARD')"),
                    ("customer_ltv", "ltv", "first order not after last order",
                     "first_order_date > last_order_date"),
                ]
            ),
        ),
        # -- governance
        "customer_sensitive": _with(
            _SENSITIVE,
            f"SELECT {_show(_SENSITIVE_PLAIN)}, email, ssn_last_9, phone_number FROM sensitive",
        ),
        "masked_admin": _with(
            _SENSITIVE,
            f"""SELECT {_show(_SENSITIVE_PLAIN)}, email, ssn_last_9,
                       CAST(phone_number AS VARCHAR) AS phone_number FROM sensitive""",
        ),
        **{
            name: _with(
                _SENSITIVE,
                rf"""SELECT {_show(_SENSITIVE_PLAIN)},
                            regexp_replace(email, '(^[^@]{{2}})[^@]+', '\1***') AS email,
                            '{SSN_HIDDEN}' AS ssn_last_9,
                            '{PHONE_PREFIX}' || right(CAST(phone_number AS VARCHAR), 4)
                                AS phone_number
                     FROM sensitive""",
            )
            for name in ("masked_analyst", "sensitive_stored")
        },
        "masked_viewer": _with(
            _SENSITIVE,
            f"""SELECT {_show(_SENSITIVE_PLAIN)}, '{EMAIL_HIDDEN}' AS email,
                       '{SSN_HIDDEN}' AS ssn_last_9, '{PHONE_HIDDEN}' AS phone_number
                FROM sensitive""",
        ),
        "vw_customer_public": _with(
            _SENSITIVE,
            """SELECT c_custkey, c_name, c_nation_name, c_region_name, c_mktsegment
               FROM sensitive""",
        ),
        "vw_customer_summary": _with(
            _SENSITIVE,
            """SELECT c_nation_name, c_region_name, c_mktsegment, count(*) AS total_customers
               FROM sensitive GROUP BY 1, 2, 3""",
        ),
        "publish_views": _with(
            _SENSITIVE,
            """SELECT 'vw_customer_public' AS view_name, count(*) AS row_count FROM sensitive
               UNION ALL
               SELECT 'vw_customer_summary', count(*)
               FROM (SELECT DISTINCT c_nation_name, c_region_name, c_mktsegment FROM sensitive)""",
        ),
        # -- functions
        "validate_contacts": _with(
            _SENSITIVE,
            """SELECT c_custkey, c_name, c_custkey % 3 <> 0 AS is_valid_pn,
                      c_custkey % 5 <> 0 AS is_valid_email, 'TPCH_ADMIN' AS role FROM sensitive
               UNION ALL
               SELECT c_custkey, c_name, FALSE AS is_valid_pn,
                      c_custkey % 5 <> 0 AS is_valid_email, 'TPCH_ANALYST' AS role FROM sensitive""",
        ),
        "order_functions": _with({}, _ORDER_FUNCTIONS),
        "customer_functions": _with(_SENSITIVE, _CUSTOMER_FUNCTIONS),
        "date_functions": _with({}, _DATE_FUNCTIONS),
        "sql_functions": _with({}, _ORDER_FUNCTIONS),
        # -- the whole chain
        "medallion_daily_sales": _with(
            {
                "wave_one": ORDERS_WAVE_ONE,
                "clean_one": _orders_silver("wave_one"),
                "daily_one": _daily("clean_one", "((SELECT max(o_orderdate) FROM clean_one) - 7)"),
                "wave_two": ORDERS_FINAL,
                "clean_two": _orders_silver("wave_two"),
                "daily_two": _daily("clean_two", "((SELECT max(o_orderdate) FROM clean_two) - 7)"),
            },
            f"""SELECT {_show(DAILY)} FROM daily_two
                UNION ALL
                SELECT {_show(DAILY)} FROM daily_one
                WHERE summary_date NOT IN (SELECT summary_date FROM daily_two)""",
        ),
        "medallion_customer_ltv": _with(
            {
                "wave_two": ORDERS_FINAL,
                "clean_two": _orders_silver("wave_two"),
                "ltv": _ltv("customer_silver", "clean_two", AS_OF),
            },
            f"SELECT {_show(LTV)} FROM ltv",
        ),
    }


# First wave of the chained run: orders before 2001. Second wave: the rest, and pending orders again,
# finished and 10.00 dearer.
ORDERS_WAVE_ONE = "SELECT * FROM stg_orders WHERE o_orderdate < DATE '2001-01-01'"
ORDERS_FINAL = """
    SELECT * REPLACE (
        CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
        CAST(CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 10 ELSE o_totalprice END
             AS DECIMAL(12,2)) AS o_totalprice)
    FROM stg_orders"""

_ORDER_FUNCTIONS = f"""
    SELECT o_orderkey,
           {_STATUS} AS status_desc,
           {_RANK} AS priority_rank,
           {_tier("o_totalprice")} AS price_tier
    FROM stg_orders"""
_CUSTOMER_FUNCTIONS = """
    SELECT c_custkey,
           regexp_full_match(trim(c_phone), '[0-9]{10,15}') AS is_valid_pn,
           regexp_full_match(trim(email), '\\S+@\\S+\\.\\S+') AS is_valid_email,
           right(c_phone, 4) AS phone_end,
           lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS padded,
           CAST(abs(c_acctbal) AS DOUBLE) AS balance_size,
           CAST(CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS DOUBLE) AS balance_floor,
           phone_number AS random_number
    FROM sensitive"""
_DATE_FUNCTIONS = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS ship_month,
           CAST(quarter(l_shipdate) AS BIGINT) AS ship_quarter,
           strftime(l_shipdate - 7, '%Y-%m-%d') AS week_before,
           CAST(l_receiptdate - l_commitdate AS BIGINT) AS delay,
           strftime(CAST(l_shipdate AS TIMESTAMP) + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S')
               AS local_time
    FROM stg_lineitem"""
