from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from tidewater.plans import gold
from tidewater.schemas import CUSTOMER_LTV, CUSTOMER_SILVER, CUSTOMER_TOTALS, DAILY_CUSTOMERS, DAILY_SALES_SUMMARY, ORDERS_SILVER

D = Decimal
OLD = datetime(1990, 1, 1)


def orders(spark, *data):
    return spark.createDataFrame(
        [(k, c, d, D(p)) for k, c, d, p in data],
        "o_orderkey bigint, o_custkey bigint, o_orderdate date, o_totalprice decimal(12,2)",
    )


def customers(spark, *keys, stamp=OLD):
    return spark.createDataFrame(
        [(k, f"c{k}", "N", "R", "M", stamp) for k in keys],
        "c_custkey bigint, c_name string, c_nation_name string, c_region_name string,"
        " c_mktsegment string, load_timestamp timestamp",
    )


DAY = date(1998, 8, 2)


def test_look_back_window_is_inclusive(spark, store):
    data = [
        (1, 1, DAY, "10.00"),
        (2, 1, DAY, "20.01"),
        (3, 2, date(1998, 7, 26), "5.00"),  # exactly seven days before
        (4, 2, date(1998, 7, 25), "7.00"),  # eight days before
    ]
    store.overwrite(ORDERS_SILVER, orders(spark, *data))
    result = gold.load_daily_sales_summary(store)
    assert result.rows_affected == 2
    got = rows(
        store.read(DAILY_SALES_SUMMARY),
        "summary_date", "order_quarter", "total_orders", "total_customers", "total_revenue",
        "avg_order_value", "min_order_value", "max_order_value",
    )
    assert got == [
        (date(1998, 7, 26), 3, 1, 1, D("5.00"), D("5.00"), D("5.00"), D("5.00")),
        (DAY, 3, 2, 1, D("30.01"), D("15.01"), D("10.00"), D("20.01")),
    ]


def test_older_days_stay_and_window_days_are_updated(spark, store):
    store.overwrite(ORDERS_SILVER, orders(spark, (1, 1, DAY, "10.00")))
    gold.load_daily_sales_summary(store, now=F.lit(datetime(2024, 1, 1)))
    later = [(1, 1, DAY, "99.00"), (2, 1, date(1998, 8, 10), "1.00"), (3, 1, date(1998, 8, 5), "2.00")]
    store.overwrite(ORDERS_SILVER, orders(spark, *later))
    gold.load_daily_sales_summary(store, now=F.lit(datetime(2024, 1, 2)))
    assert rows(store.read(DAILY_SALES_SUMMARY), "summary_date", "total_revenue", "load_timestamp") == [
        (DAY, D("10.00"), datetime(2024, 1, 1)),
        (date(1998, 8, 5), D("2.00"), datetime(2024, 1, 2)),
        (date(1998, 8, 10), D("1.00"), datetime(2024, 1, 2)),
    ]


def test_empty_orders_stop_both_jobs(store):
    store.create(ORDERS_SILVER)
    assert gold.load_daily_sales_summary(store).rows_affected == 0
    assert gold.load_customer_ltv(store).rows_affected == 0


def test_ltv_values_and_customer_without_orders(spark):
    as_of = date(1998, 9, 2)
    o = orders(
        spark,
        (1, 1, date(1998, 6, 4), "250000.00"),  # exactly 90 days before: active
        (2, 1, date(1998, 1, 1), "250000.00"),
        (3, 2, date(1998, 6, 3), "10000.00"),  # 91 days before: inactive
        (4, 9, date(1998, 9, 1), "1.00"),  # customer unknown
    )
    c = customers(spark, 1, 2, 3)
    got = rows(
        gold.customer_ltv(c, o, c.select("c_custkey"), as_of),
        "c_custkey", "total_orders", "total_spent", "avg_order_value", "first_order_date",
        "last_order_date", "customer_tenure_days", "customer_tier", "is_active",
    )
    assert got == [
        (1, 2, D("500000.00"), D("250000.00"), date(1998, 1, 1), date(1998, 6, 4), 244, "VIP", True),
        (2, 1, D("10000.00"), D("10000.00"), date(1998, 6, 3), date(1998, 6, 3), 91, "SILVER", False),
        (3, 0, None, None, None, None, None, "STANDARD", False),
    ]


def test_affected_customers(spark):
    o = orders(spark, (1, 1, DAY, "1.00"), (2, 2, date(1998, 7, 1), "1.00"), (3, 1, DAY, "1.00"))
    stamped = customers(spark, 2, 3).union(customers(spark, 4, stamp=datetime(1998, 7, 26)))
    got = gold.affected_customers(o, stamped, gold.window_start(DAY))
    assert rows(got) == [(1,), (4,)]


def test_ltv_job_refreshes_keeps_and_deactivates(spark, store):
    first = [(1, 1, DAY, "10.00"), (2, 2, DAY, "20.00"), (3, 3, DAY, "30.00")]
    store.overwrite(CUSTOMER_SILVER, customers(spark, 1, 2, 3, 4))
    store.overwrite(ORDERS_SILVER, orders(spark, *first))
    one = gold.load_customer_ltv(store, date(1998, 9, 2))
    assert one.rows_affected == 3
    again = gold.load_customer_ltv(store, date(1998, 9, 2))
    assert again.rows_affected == 3 and "0 deactivated" in again.message
    store.overwrite(ORDERS_SILVER, orders(spark, *first, (4, 1, date(1999, 1, 5), "5.00")))
    two = gold.load_customer_ltv(store, date(1999, 1, 6))
    assert two.rows_affected == 3 and "1 customers refreshed, 2 deactivated" in two.message
    assert rows(store.read(CUSTOMER_LTV), "c_custkey", "total_spent", "is_active") == [
        (1, D("15.00"), True),
        (2, D("20.00"), False),
        (3, D("30.00"), False),
    ]


def test_no_affected_customers(spark, store):
    store.overwrite(CUSTOMER_SILVER, customers(spark, 1))
    store.overwrite(ORDERS_SILVER, orders(spark, (1, 1, DAY, "10.00")))
    result = gold.load_customer_ltv(store, lookback_days=-1)
    assert result.rows_affected == 0 and result.message


def test_preview_groups_orders_without_customer(spark):
    o = orders(
        spark,
        (1, 1, DAY, "10.00"),
        (2, 8, DAY, "20.00"),
        (3, 9, DAY, "40.01"),
        (4, 9, date(1990, 1, 1), "1.00"),
        (5, 2, date(1990, 1, 1), "1.00"),
    )
    got = gold.customer_ltv_preview(customers(spark, 1, 2), o, gold.window_start(DAY))
    assert rows(got, "c_custkey", "total_orders", "total_spent", "avg_order_value") == [
        (None, 3, D("61.01"), D("20.34")),
        (1, 1, D("10.00"), D("10.00")),
    ]


def test_orders_are_summed_before_the_shuffle(spark, store):
    """A customer with very many orders is reduced map-side, also when keys are not broadcast."""
    store.overwrite(ORDERS_SILVER, orders(spark, *[(i, 1, DAY, "1.00") for i in range(50)]))
    o, c = store.read(ORDERS_SILVER), customers(spark, 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = gold.customer_ltv(c, o, c.select("c_custkey"))
        plan = df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(o_custkey")
        assert "LeftSemi" in plan[: plan.index("partial_sum")]
        assert df.first().total_orders == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_affected_keys_without_a_customer_row(spark, store):
    store.overwrite(CUSTOMER_SILVER, customers(spark, 1))
    store.overwrite(ORDERS_SILVER, orders(spark, (1, 77, DAY, "10.00")))
    assert gold.load_customer_ltv(store).rows_affected == 0
    assert store.read(CUSTOMER_LTV).count() == 0
    store.create(CUSTOMER_LTV, replace=True)
    store.overwrite(CUSTOMER_SILVER, customers(spark, 1).limit(0))
    assert gold.load_customer_ltv(store).rows_affected == 0


def test_the_window_opens_only_blocks_with_recent_orders(spark, store):
    """Three key blocks; the newest orders are in the last, one late order of the window in the first."""
    width = 1 << 23
    data = [(1, 1, date(1998, 1, 1), "1.00"), (2, 1, DAY, "2.00"), (width, 1, date(1998, 2, 1), "3.00"), (2 * width, 2, DAY, "4.00")]
    store.overwrite(ORDERS_SILVER, orders(spark, *data))
    assert gold.newest_order_date(store) == DAY
    recent = gold.orders_since(store, date(1998, 8, 1))
    plan = recent._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "PartitionFilters: [" in plan and "key_block" in plan.split("PartitionFilters: [")[1].split("]")[0]
    opened = store.spark.table(store.table_name(ORDERS_SILVER)).where(F.col("key_block").isin(0, 2))
    assert {r[0] for r in recent.select("o_orderkey").collect()} == {2, 2 * width}
    assert sorted(recent.inputFiles()) == sorted(opened.inputFiles())
    # merges, deletes and whole writes keep the ranges right
    store.merge(ORDERS_SILVER, orders(spark, (width + 1, 3, date(1998, 8, 9), "1.00")), ["o_orderdate"], ["o_custkey", "o_orderdate"])
    assert gold.newest_order_date(store) == date(1998, 8, 9)
    store.delete_where(ORDERS_SILVER, F.col("o_orderkey") >= width)
    assert gold.newest_order_date(store) == DAY
    store.overwrite(ORDERS_SILVER, orders(spark, (5, 1, date(1990, 1, 1), "1.00")))
    assert gold.newest_order_date(store) == date(1990, 1, 1)


def stored_totals(store):
    return rows(store.read(CUSTOMER_TOTALS).where("total_orders > 0"))


def full_totals(store):
    columns = CUSTOMER_TOTALS.columns.names
    return rows(gold.order_totals(store.read(ORDERS_SILVER)).where("o_custkey IS NOT NULL").select(*columns))


def test_totals_follow_every_change(spark, store):
    silver = [(k, k % 4, date(1998, 1, 1 + k), f"{k}.50") for k in range(1, 13)]
    store.overwrite(ORDERS_SILVER, orders(spark, *silver))
    assert gold.refresh_customer_totals(store).rows_affected == 12
    assert gold.refresh_customer_totals(store).rows_affected == 0
    copied = ["o_custkey", "o_orderdate", "o_totalprice"]
    changes = [
        (1, 1, date(1999, 1, 1), "7.00"),  # the first order of customer 1 moves to the end
        (2, 3, date(1998, 1, 3), "2.50"),  # from customer 2 to customer 3
        (20, 9, date(1997, 1, 1), "1.00"),  # a new customer
        (21, 1, date(1990, 1, 1), "1.00"),  # a new first date
    ]
    store.merge(ORDERS_SILVER, orders(spark, *changes), copied, copied)
    assert gold.refresh_customer_totals(store).rows_affected == 4
    assert stored_totals(store) == full_totals(store)
    store.delete_where(ORDERS_SILVER, (F.col("o_custkey") == 0) | F.col("o_orderkey").isin(21, 3))
    store.update_where(ORDERS_SILVER, F.col("o_orderkey") == 20, {"o_totalprice": F.lit(None), "o_orderdate": F.lit(None)})
    gold.refresh_customer_totals(store)
    assert stored_totals(store) == full_totals(store)
    store.overwrite(ORDERS_SILVER, orders(spark, (1, 5, DAY, "10.00")))
    assert "built from 1 orders" in gold.refresh_customer_totals(store).message
    assert stored_totals(store) == full_totals(store)


def test_a_lost_totals_refresh_is_not_added_twice(spark, store, monkeypatch):
    import pytest

    from tidewater.operators import TableStore

    store.overwrite(ORDERS_SILVER, orders(spark, (1, 1, DAY, "10.00")))
    gold.refresh_customer_totals(store)
    store.merge(ORDERS_SILVER, orders(spark, (2, 1, DAY, "5.00")), ["o_custkey"], ["o_custkey", "o_orderdate", "o_totalprice"])

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:  # behind the commit of the totals
        patch.setattr(TableStore, "_show", lost)
        with pytest.raises(OSError):
            gold.refresh_customer_totals(store)
    gold.refresh_customer_totals(store)
    assert stored_totals(store) == full_totals(store)


def test_distinct_customers_add_up(spark, store):
    data = [(k, (k * 7919) % 70000 - 5, date(1998, 1, 1) + timedelta(days=k % 150), "1.00") for k in range(1500)]
    data += [(2000 + k, 33, DAY, "1.00") for k in range(50)] + [(3000, None, DAY, "1.00"), (3001, 4, None, "1.00")]
    store.overwrite(ORDERS_SILVER, orders(spark, *data))
    gold.load_daily_customers(store, lookback_days=None)
    for period in ("month", "quarter", "year"):
        got = gold.distinct_customers(store.read(DAILY_CUSTOMERS), F.trunc("summary_date", period))
        plain = store.read(ORDERS_SILVER).where("o_orderdate IS NOT NULL").groupBy(F.trunc("o_orderdate", period)).agg(F.count_distinct("o_custkey"))
        assert rows(got) == rows(plain)
    store.merge(ORDERS_SILVER, orders(spark, (5000, 12345, DAY, "1.00")), ["o_custkey"], ["o_custkey", "o_orderdate"])
    assert gold.load_daily_customers(store).rows_affected == 1
    days = gold.distinct_customers(store.read(DAILY_CUSTOMERS), F.col("summary_date"))
    assert dict(rows(days))[DAY] == 2
    store.overwrite(ORDERS_SILVER, orders(spark, *data[:1]).limit(0))
    assert gold.load_daily_customers(store).rows_affected == 0
