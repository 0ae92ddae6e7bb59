from __future__ import annotations

from datetime import date
from decimal import Decimal

from conftest import rows

from tidewater.plans import profiling


def test_customers_per_country_counts_versions_once(spark):
    customer = spark.createDataFrame(
        [(1, 5), (1, 5), (2, 5), (3, 6), (4, 99)], "c_custkey int, c_nationkey int"
    )
    nation = spark.createDataFrame([(5, "X"), (6, "A"), (7, "none")], "n_nationkey int, n_name string")
    got = profiling.customers_per_country(customer, nation).collect()
    assert [tuple(r) for r in got] == [("X", 2), ("A", 1)]


def test_top_part_types(spark):
    data = [(o, f"t{i:02}") for i in range(12) for o in range(12 - i) for _ in range(2)]
    got = profiling.top_part_types(spark.createDataFrame(data, "l_orderkey int, l_part_type string"))
    assert [tuple(r) for r in got.collect()] == [(f"t{i:02}", 12 - i) for i in range(10)]


def test_status_profiles(spark):
    orders = spark.createDataFrame(
        [
            (1, 1, "OPEN", date(1995, 1, 1), Decimal("1.00"), 1995, 1),
            (2, 1, "OPEN", date(1995, 1, 9), Decimal("2.00"), 1995, 1),
            (3, 2, "OPEN", date(1994, 12, 31), Decimal("9.00"), 1994, 12),
        ],
        "o_orderkey int, o_custkey int, o_orderstatus_desc string, o_orderdate date,"
        " o_totalprice decimal(12,2), o_order_year int, o_order_month int",
    )
    assert rows(profiling.monthly_status_profile(orders)) == [
        (1995, 1, "OPEN", 2, Decimal("3.00"), Decimal("1.500000"), 1)
    ]
    assert rows(profiling.orders_by(orders.union(orders), "o_orderstatus_desc")) == [("OPEN", 3)]
    assert rows(profiling.orders_by(orders, "o_orderstatus_desc", unique_keys=True)) == [("OPEN", 3)]


def test_load_probe(spark):
    staged = spark.createDataFrame(
        [(1, "2024-01-01", "a"), (5, "2024-01-02", "b"), (6, "2024-01-03", "c"), (7, None, None)],
        "o_orderkey int, created_at string, from_source string",
    )
    found = profiling.load_probe(staged, "o_orderkey", 5).collect()
    assert [(r.o_orderkey, r.from_source) for r in found] == [(7, None), (6, "c"), (5, "b")]


def test_counts_nulls_and_keys(spark):
    a = spark.createDataFrame([(1, None), (1, "x"), (None, None), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x")], "k int, v string")
    assert rows(profiling.row_counts({"a": a, "b": b})) == [("a", 4), ("b", 1)]
    assert rows(profiling.null_counts({"a": a, "b": b})) == [
        ("a", "k", 2), ("a", "v", 2), ("b", "k", 0), ("b", "v", 0),
    ]
    assert rows(profiling.duplicate_keys(a, ["k"])) == [(None, 2), (1, 2)]
    assert rows(profiling.key_uniqueness({"a": (a, ["k"]), "b": (b, ["k"])})) == [
        ("a", 2, 2), ("b", 0, 0),
    ]


def test_null_counts_read_each_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id AS b", "id AS c").write.parquet(path)
    plan = profiling.null_counts({"t": spark.read.parquet(path)})._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("FileScan") == 1


def test_rule_violations(spark):
    orders = spark.createDataFrame(
        [
            ("OPEN", 1, date(1995, 1, 1), 1995, 1, 1),
            ("odd", 7, date(1995, 1, 1), 1995, 1, 1),
            (None, None, date(1995, 5, 1), 1995, 5, 1),
        ],
        "o_orderstatus_desc string, o_priority_rank int, o_orderdate date, o_order_year int,"
        " o_order_month int, o_order_quarter int",
    )
    lines = spark.createDataFrame(
        [(-1, Decimal(1), Decimal(2), Decimal(3)), (None, Decimal(5), Decimal(2), Decimal(3))],
        "l_ship_delay_days int, l_net_price decimal(12,2), l_extendedprice decimal(12,2),"
        " l_final_price decimal(12,2)",
    )
    got = rows(
        profiling.rule_violations(
            {"o": (orders, profiling.order_rules()), "l": (lines, profiling.lineitem_rules())}
        )
    )
    assert {(t, r): n for t, r, n in got} == {
        ("o", "order status description in domain"): 2,
        ("o", "order priority rank in domain"): 2,
        ("o", "order date parts agree with date"): 1,
        ("l", "ship delay not negative"): 1,
        ("l", "net price not above extended price"): 1,
        ("l", "final price not below net price"): 1,
    }
