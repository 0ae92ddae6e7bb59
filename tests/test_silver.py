from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewater.operators import append_feed, table_changes
from tidewater.plans import silver
from tidewater.schemas import LINEITEM_SILVER, ORDERS_SILVER, STAGING

D = Decimal


def staged(spark, table, *records):
    """Staging rows from dicts; columns not given are NULL."""
    schema = STAGING[table].read_schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in records], schema)


def order(key, **kw):
    base = {
        "o_orderkey": key,
        "o_custkey": 1,
        "o_orderstatus": "O",
        "o_totalprice": D("10.00"),
        "o_orderdate": date(1998, 5, 31),
        "o_orderpriority": "1-URGENT",
        "o_clerk": "Clerk#000000007",
        "created_at": datetime(2024, 1, 1),
    }
    return {**base, **kw}


def line(key, number=1, **kw):
    base = {
        "l_orderkey": key,
        "l_linenumber": number,
        "l_partkey": 1,
        "l_suppkey": 1,
        "l_extendedprice": D("100.05"),
        "l_discount": D("0.10"),
        "l_tax": D("0.08"),
        "l_commitdate": date(1998, 1, 10),
        "l_receiptdate": date(1998, 1, 12),
        "created_at": datetime(2024, 1, 1),
    }
    return {**base, **kw}


def test_order_enrichment(spark):
    row = silver.orders_silver(staged(spark, "orders", order(1))).first()
    assert (row.o_order_year, row.o_order_month, row.o_order_quarter) == (1998, 5, 2)
    assert (row.o_orderstatus_desc, row.o_priority_rank, row.o_clerk_id) == ("OPEN", 1, D(7))


def test_prices_are_rounded_once(spark):
    cases = [("100.05", "0.10", "0.08"), ("0.05", "0.10", "0.10"), ("99.99", "0.00", "0.00")]
    data = [
        line(i, l_extendedprice=D(p), l_discount=D(d), l_tax=D(t))
        for i, (p, d, t) in enumerate(cases)
    ]
    part = staged(spark, "part", {"p_partkey": 1, "p_name": "p", "p_type": "t"})
    supplier = staged(spark, "supplier", {"s_suppkey": 1, "s_name": "s"})
    got = {
        r.l_orderkey: (r.l_net_price, r.l_final_price)
        for r in silver.lineitem_silver(staged(spark, "lineitem", *data), part, supplier).collect()
    }
    cent = D("0.01")
    for i, (p, d, t) in enumerate(cases):
        net = D(p) * (1 - D(d))
        assert got[i] == (
            net.quantize(cent, "ROUND_HALF_UP"),
            (net * (1 + D(t))).quantize(cent, "ROUND_HALF_UP"),
        )


def test_ship_delay(spark):
    commit = date(1998, 1, 10)
    data = [
        line(1, l_receiptdate=date(1998, 1, 8)),
        line(2, l_receiptdate=commit),
        line(3, l_receiptdate=date(1998, 1, 13)),
        line(4, l_receiptdate=None),
    ]
    empty_part, empty_supplier = staged(spark, "part"), staged(spark, "supplier")
    got = silver.lineitem_silver(staged(spark, "lineitem", *data), empty_part, empty_supplier)
    assert rows(got, "l_orderkey", "l_ship_delay_days", "l_part_name") == [
        (1, 0, None),
        (2, 0, None),
        (3, 3, None),
        (4, None, None),
    ]


def test_customer_lookups_are_left_joins(spark):
    customers = staged(
        spark, "customer", {"c_custkey": 1, "c_nationkey": 5}, {"c_custkey": 2, "c_nationkey": 6},
        {"c_custkey": 3},
    )
    nation = staged(
        spark,
        "nation",
        {"n_nationkey": 5, "n_name": "old", "n_regionkey": 9, "created_at": datetime(2024, 1, 1)},
        {"n_nationkey": 5, "n_name": "new", "n_regionkey": 9, "created_at": datetime(2024, 1, 2)},
    )
    region = staged(spark, "region", {"r_regionkey": 9, "r_name": "R"})
    got = silver.customer_silver(
        customers, silver.lookup_nation(nation), silver.lookup_region(region)
    )
    assert rows(got, "c_custkey", "c_nation_name", "c_regionkey", "c_region_name") == [
        (1, "new", 9, "R"),
        (2, None, None, None),
        (3, None, None, None),
    ]


def test_apply_changes_to_orders(spark, store):
    t1, t2 = F.lit(datetime(2024, 5, 1)), F.lit(datetime(2024, 5, 2))
    before = staged(spark, "orders", order(1), order(2), order(3))
    store.write_batch(STAGING["orders"], before, 0)
    silver.full_load(store, silver.ORDERS_JOB, t1)
    after = staged(
        spark,
        "orders",
        order(1),
        order(2, o_orderstatus="F", created_at=datetime(2024, 2, 2)),
        order(4, created_at=datetime(2024, 2, 2)),
    )
    feed = table_changes(before, after, ["o_orderkey"])
    counts = silver.apply_changes(store, silver.ORDERS_JOB, feed, t2)
    assert (counts.inserted, counts.updated) == (1, 1)
    columns = ("o_orderkey", "o_orderstatus_desc", "first_loaded_at", "last_updated_at")
    expected = [
        (1, "OPEN", datetime(2024, 1, 1), datetime(2024, 5, 1)),
        (2, "FINISHED", datetime(2024, 1, 1), datetime(2024, 5, 2)),  # first load is kept
        (3, "OPEN", datetime(2024, 1, 1), datetime(2024, 5, 1)),  # deletes are not applied
        (4, "OPEN", datetime(2024, 2, 2), datetime(2024, 5, 2)),
    ]
    assert rows(store.read(ORDERS_SILVER), *columns) == expected
    silver.apply_changes(store, silver.ORDERS_JOB, feed, t2)
    assert rows(store.read(ORDERS_SILVER), *columns) == expected


def test_a_feed_of_deletes_changes_nothing(spark, store):
    before = staged(spark, "orders", order(1))
    store.write_batch(STAGING["orders"], before, 0)
    silver.full_load(store, silver.ORDERS_JOB)
    feed = table_changes(before, before.limit(0), ["o_orderkey"])
    assert silver.apply_changes(store, silver.ORDERS_JOB, feed).affected == 0
    assert store.read(ORDERS_SILVER).count() == 1


def test_merge_job_follows_its_feed(spark, store):
    silver.ORDERS_JOB.feed(store).start()
    assert silver.merge_orders_cdc(store).rows_affected == 0
    store.write_batch(STAGING["orders"], staged(spark, "orders", order(1), order(1), order(2)), 0)
    result = silver.merge_orders_cdc(store)
    assert result.rows_affected == 2 and "3 change rows" in result.message
    assert silver.merge_orders_cdc(store).rows_affected == 0


def test_batches_give_the_same_as_a_full_load(spark, store, tmp_path):
    from tidewater.operators import TableStore

    batches = [
        [line(k, n, created_at=datetime(2024, 1, 1 + b), l_tax=D("0.01") * b)
         for k in range(b, b + 4) for n in (1, 2)]
        for b in range(3)
    ]
    lookups = {
        "part": staged(spark, "part", {"p_partkey": 1, "p_name": "p", "p_type": "t"}),
        "supplier": staged(spark, "supplier", {"s_suppkey": 1, "s_name": "s"}),
    }
    stepwise, full = store, TableStore(spark, str(tmp_path / "full"))
    for target in (stepwise, full):
        for name, df in lookups.items():
            target.write_batch(STAGING[name], df, 0)
    for number, batch in enumerate(batches):
        df = staged(spark, "lineitem", *batch)
        full.write_batch(STAGING["lineitem"], df, number)
        silver.apply_changes(
            stepwise, silver.LINEITEM_JOB, append_feed(df, STAGING["lineitem"].keys)
        )
    silver.full_load_lineitem(full)
    one = rows(stepwise.read(LINEITEM_SILVER).drop("load_timestamp"))
    assert one == rows(full.read(LINEITEM_SILVER).drop("load_timestamp"))
    assert len({r[:2] for r in one}) == len(one) == 12


def test_lookup_is_cut_to_the_batch(spark):
    lookup = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "k int, v string")
    batch = spark.createDataFrame([(1,), (1,), (7,), (None,), (99,)], "f int")
    assert rows(silver.only_needed(lookup, "k", batch, "f")) == [(1, "v1"), (7, "v7")]


def versions(spark, lines):
    """Line items in up to three versions, some stamped alike, some without stamp, key, part or supplier."""
    number = lambda c, bits: F.pmod(F.xxhash64("id", F.lit(c)), F.lit(bits))
    have = {
        "l_orderkey": F.when(F.col("id") % 41 != 0, F.col("id") % (lines // 2)),
        "l_linenumber": F.lit(1),
        "l_partkey": F.when(number("p", 9) > 0, number("p", 9)),
        "l_suppkey": F.when(number("s", 5) > 0, number("s", 5)),
        "l_extendedprice": number("e", 90),
        "l_discount": F.lit("0.10"),
        "l_comment": F.concat(F.lit("c"), number("c", 7).cast("string")),
        "from_source": F.concat(F.lit("f"), number("f", 7).cast("string")),
        "created_at": F.when(number("t", 4) > 0, F.timestamp_seconds(number("t", 4))),
    }
    fields = STAGING["lineitem"].read_schema
    return spark.range(0, lines, 1, 3).select(
        *[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def lookups(spark):
    part = staged(spark, "part", *[{"p_partkey": i, "p_name": f"p{i}", "p_type": "t"} for i in range(7)])
    supplier = staged(spark, "supplier", *[{"s_suppkey": i, "s_name": f"s{i}"} for i in range(3)])
    return part, supplier


@pytest.mark.parametrize("limit", [10, 5, 0])
@pytest.mark.parametrize("partitions", [None, 4])
@pytest.mark.parametrize("hot", [False, True])
def test_dealt_line_items_are_the_same(spark, monkeypatch, limit, partitions, hot):
    """Whatever the order of exchange and lookups: both, one or no lookup broadcast, and a key with most versions."""
    monkeypatch.setattr(silver, "BROADCAST_ROWS", limit)
    lines = versions(spark, 3000)
    if hot:
        lines = lines.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 5 > 0, 1).otherwise(F.col("l_orderkey")))
    part, supplier = lookups(spark)
    plain = silver.lineitem_silver(lines, silver.lookup_part(part), silver.lookup_supplier(supplier))
    for batch in (False, True):
        assert rows(silver.stored_lineitem(lines, part, supplier, partitions, batch)) == rows(plain)


@pytest.mark.parametrize("limit", [5, 0])
def test_large_lookups_do_not_move_whole_line_items(spark, monkeypatch, tmp_path, limit):
    """With a key on every line, only the lines' keys go to a lookup that is too large to broadcast."""
    monkeypatch.setattr(silver, "BROADCAST_ROWS", limit)
    versions(spark, 3000).where("l_orderkey IS NOT NULL").write.parquet(f"{tmp_path}/lines")
    lines = spark.read.parquet(f"{tmp_path}/lines")
    part, supplier = lookups(spark)
    plain = silver.lineitem_silver(lines, silver.lookup_part(part), silver.lookup_supplier(supplier))
    for batch in (False, True):
        found = silver.stored_lineitem(lines, part, supplier, 4, batch)
        assert rows(found) == rows(plain)
        before = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # plans with their children in order
        try:
            plan = silver.stored_lineitem(lines, part, supplier, 4, batch)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", before)
        steps = [x for x in plan.splitlines() if "ColumnarToRow" not in x]
        whole = [x for x, below in zip(steps, steps[1:]) if "Exchange hashpartitioning" in x and "l_comment" in below]
        assert len(whole) == 1 and "hashpartitioning(l_orderkey" in whole[0] and ", 4)" in whole[0]


def exchanges_of_a_full_load(spark, store, monkeypatch, job):
    """Exchanges by key in the plan of a first whole write, with more shuffle partitions than buckets."""
    store.create(job.target)
    written = []
    monkeypatch.setattr(store, "_replace", lambda spec, rows, **_: written.append(rows))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        silver.full_load(store, job)
        plan = written[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return [line for line in plan.splitlines() if f"Exchange hashpartitioning({job.target.keys[0]}" in line]


def test_line_items_are_exchanged_once_for_a_full_load(spark, store, monkeypatch):
    part, supplier = lookups(spark)
    store.write_batch(STAGING["part"], part, 0)
    store.write_batch(STAGING["supplier"], supplier, 0)
    store.write_batch(STAGING["lineitem"], versions(spark, 3000), 0)
    monkeypatch.setattr(silver, "BROADCAST_ROWS", 5, raising=False)
    found = exchanges_of_a_full_load(spark, store, monkeypatch, silver.LINEITEM_JOB)
    assert len(found) == 1 and ", 4)" in found[0]


def test_orders_are_exchanged_once_for_a_full_load(spark, store, monkeypatch):
    store.write_batch(STAGING["orders"], staged(spark, "orders", *[order(i) for i in range(400)]), 0)
    found = exchanges_of_a_full_load(spark, store, monkeypatch, silver.ORDERS_JOB)
    assert len(found) == 1 and ", 4)" in found[0]
