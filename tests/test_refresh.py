from __future__ import annotations

import shutil
import threading
import time
from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewater.operators import TableStore
from tidewater.plans import refresh as refresh_module
from tidewater.plans import silver
from tidewater.plans.refresh import create_tables, initial_load, refresh, start_feeds
from tidewater.schemas import CUSTOMER_LTV, CUSTOMER_SILVER, DAILY_SALES_SUMMARY, LINEITEM_SILVER
from tidewater.schemas import ORDERS_SILVER, STAGING
from tidewater.session import freed_shuffles
from tidewater.verification import queries

D = Decimal
AS_OF = date(1998, 9, 2)


def deliver(stage, name, *lines):
    (stage / f"tpch_sf1_{name}.csv").write_text("header\n" + "".join(f"{x}\n" for x in lines))


def order(key, customer, price, day, status="O"):
    return f"{key},{customer},{status},{price},{day},1-URGENT,Clerk#{key:09d},0,c"


def base(stage):
    deliver(stage, "region_1", "1,ASIA,c")
    deliver(stage, "nation_1", "5,JAPAN,1,c")
    deliver(stage, "customer_1", "1,one,a,5,p,0.00,M,c", "2,two,a,99,p,0.00,M,c")
    deliver(stage, "supplier_1", "3,supp,a,5,p,0.00,c")
    deliver(stage, "part_1", "7,part,m,b,TYPE,1,box,1.00,c")
    deliver(stage, "partsupp_1", "7,3,1,1.00,c")
    deliver(stage, "line_item_1", "1,7,3,1,1,100.00,0.10,0.05,N,O,1998-07-01,1998-07-03,1998-07-05,i,m,c")
    deliver(stage, "orders_1", order(1, 1, "100.00", "1998-08-01"), order(2, 1, "50.00", "1998-07-01"))


def test_two_waves(spark, store, stage):
    create_tables(store)
    start_feeds(store)
    base(stage)
    results = refresh(store, str(stage), AS_OF)
    assert [r.rows_affected for r in results] == [2, 2, 1, 1, 2]
    assert rows(store.read(CUSTOMER_SILVER), "c_custkey", "c_nation_name", "c_region_name") == [
        (1, "JAPAN", "ASIA"),
        (2, None, None),
    ]
    assert rows(store.read(LINEITEM_SILVER), "l_part_type", "l_net_price", "l_final_price", "l_ship_delay_days") == [
        ("TYPE", D("90.00"), D("94.50"), 2)
    ]
    columns = ("c_custkey", "total_orders", "total_spent", "is_active")
    assert rows(store.read(CUSTOMER_LTV), *columns) == [
        (1, 2, D("150.00"), True),
        (2, 0, None, False),
    ]

    deliver(stage, "orders_2", order(2, 1, "60.00", "1998-07-01", "F"), order(3, 2, "5.00", "1998-08-03"))
    results = refresh(store, str(stage), AS_OF)
    assert [r.rows_affected for r in results[:3]] == [2, 0, 0]
    assert rows(store.read(ORDERS_SILVER), "o_orderkey", "o_orderstatus_desc") == [
        (1, "OPEN"), (2, "FINISHED"), (3, "OPEN"),
    ]
    assert rows(store.read(CUSTOMER_LTV), *columns) == [
        (1, 2, D("160.00"), True),
        (2, 1, D("5.00"), True),
    ]
    assert rows(store.read(DAILY_SALES_SUMMARY), "summary_date", "total_revenue") == [
        (date(1998, 8, 1), D("100.00")), (date(1998, 8, 3), D("5.00")),
    ]

    quiet = [rows(store.read(t).drop("load_timestamp", "last_updated_at")) for t in (ORDERS_SILVER, CUSTOMER_LTV)]
    results = refresh(store, str(stage), AS_OF)
    assert [r.rows_affected for r in results[:3]] == [0, 0, 0]
    assert quiet == [
        rows(store.read(t).drop("load_timestamp", "last_updated_at")) for t in (ORDERS_SILVER, CUSTOMER_LTV)
    ]


def test_a_lost_merge_is_finished_once_or_repeated(spark, store, stage, monkeypatch):
    create_tables(store)
    start_feeds(store)
    base(stage)
    from tidewater.operators.versions import Versions
    from tidewater.plans.refresh import ingest_all

    def lost(*args):
        raise RuntimeError("driver lost")

    ingest_all(store, str(stage), ("orders",))
    with monkeypatch.context() as patch:  # before the commit: nothing has happened
        patch.setattr(Versions, "commit", lost)
        with pytest.raises(RuntimeError):
            silver.merge_orders_cdc(store)
    assert store.read(ORDERS_SILVER).count() == 0
    with monkeypatch.context() as patch:  # between the rows and the offset
        patch.setattr(TableStore, "commit_offset", lost)
        with pytest.raises(RuntimeError):
            silver.merge_orders_cdc(store)
    first = rows(store.read(ORDERS_SILVER))
    assert len(first) == 2
    assert silver.merge_orders_cdc(store).rows_affected == 0  # finished, not applied again
    assert rows(store.read(ORDERS_SILVER)) == first


def test_bulk_load_first_then_pipes(spark, store, stage, tmp_path):
    """Bulk rows are there before the feeds start: they come in by a full load, not as changes."""
    bulk = tmp_path / "bulk"
    bulk.mkdir()
    deliver(bulk, "orders", order(1, 1, "100.00", "1998-08-01"))
    initial_load(store, str(bulk), ("orders",))
    initial_load(store, str(bulk), ("orders",))  # repeating it loads nothing twice
    start_feeds(store)
    assert silver.merge_orders_cdc(store).rows_affected == 0
    silver.full_load_orders(store)
    deliver(stage, "orders_1", order(1, 1, "90.00", "1998-08-01"), order(2, 1, "1.00", "1998-08-01"))
    from tidewater.plans.refresh import ingest_all

    ingest_all(store, str(stage), ("orders",))
    assert silver.merge_orders_cdc(store).rows_affected == 2
    assert rows(store.read(ORDERS_SILVER), "o_orderkey", "o_totalprice") == [(1, D("90.00")), (2, D("1.00"))]
    # A full reload prefers the unstamped bulk row over its stamped redelivery.
    silver.full_load_orders(store)
    assert rows(store.read(ORDERS_SILVER), "o_orderkey", "o_totalprice", "first_loaded_at")[0] == (1, D("100.00"), None)
    assert store.read(STAGING["orders"]).count() == 3


def test_later_bulk_loads_add_and_reach_the_feed(spark, store, stage):
    deliver(stage, "orders_1", order(1, 1, "1.00", "1998-08-01"), order(2, 1, "2.00", "1998-08-01"))
    initial_load(store, str(stage), ("orders",))
    start_feeds(store)
    deliver(stage, "orders_2", order(3, 1, "3.00", "1998-08-01"))
    initial_load(store, str(stage), ("orders",))
    assert store.read(STAGING["orders"]).count() == 3
    assert silver.merge_orders_cdc(store).rows_affected == 1


def test_a_new_checkpoint_replaces_nothing(spark, store, stage, tmp_path):
    from tidewater.plans.refresh import ingest_all

    create_tables(store)
    deliver(stage, "orders_1", order(1, 1, "1.00", "1998-08-01"))
    ingest_all(store, str(stage), ("orders",))
    shutil.move(store.control_path("ingest"), tmp_path / "lost")
    later = tmp_path / "later"
    later.mkdir()
    deliver(later, "orders_2", order(2, 1, "2.00", "1998-08-01"))
    ingest_all(store, str(later), ("orders",))
    assert rows(store.read(STAGING["orders"]), "o_orderkey") == [(1,), (2,)]


def test_changes_in_one_batch_keep_the_newest(spark, store, stage):
    """Without a stamp difference inside one file the tie-break decides, the same way every time."""
    other = TableStore(spark, store.root + "-other")
    for target in (store, other):
        start_feeds(target)
        deliver(stage, "orders_1", order(1, 1, "2.00", "1998-08-01"), order(1, 1, "1.00", "1998-08-01"))
        from tidewater.plans.refresh import ingest_all

        ingest_all(target, str(stage), ("orders",))
        silver.merge_orders_cdc(target)
    assert rows(store.read(ORDERS_SILVER), "o_totalprice") == rows(other.read(ORDERS_SILVER), "o_totalprice")


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in manager.getAllFiles().mkString("\n").splitlines() if name.endswith(".data")}


def test_shuffle_files_go_with_their_query(spark):
    def grouped():
        return spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count()

    before = shuffle_files(spark)
    held = grouped()
    held.collect()
    assert shuffle_files(spark) - before  # kept as long as the driver holds the query
    before = shuffle_files(spark)
    with freed_shuffles(spark):
        freed = grouped()
        assert len(freed.collect()) == 7
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert len(freed.collect()) == 7  # run again, it shuffles again


def test_a_refresh_frees_its_shuffles(spark, store, stage, monkeypatch):
    seen = []
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    load = refresh_module.load_customer_ltv
    monkeypatch.setattr(refresh_module, "load_customer_ltv", lambda *a, **k: (seen.append(spark.conf.get(name)), load(*a, **k))[1])
    create_tables(store)
    start_feeds(store)
    base(stage)
    was = spark.conf.get(name)
    refresh(store, str(stage), AS_OF)
    assert seen == ["true"] and spark.conf.get(name) == was


def test_steps_side_by_side_have_their_own_properties(spark, store):
    """Shared ones also hold the number of the running query, which then fails when another step's query ends."""
    both = threading.Barrier(2, timeout=30)

    def step(number):
        def run():
            spark.sparkContext.setLocalProperty("tidewater.step", str(number))
            both.wait()
            return spark.sparkContext.getLocalProperty("tidewater.step")

        return run

    assert refresh_module._side_by_side(store, [step(1), step(2)]) == ["1", "2"]


def test_loaded_text_is_taken_back(spark, tmp_path, monkeypatch):
    """The whole chain keeps no delivered text beside the tables loaded from it."""
    given = {
        "region": "SELECT 1L AS r_regionkey, 'ASIA' AS r_name",
        "nation": "SELECT 5L AS n_nationkey, 'JAPAN' AS n_name, 1L AS n_regionkey",
        "customer": "SELECT id AS c_custkey, 'c' AS c_name, 5L AS c_nationkey, 0.5D AS c_acctbal, 'M' AS c_mktsegment FROM range(1, 3)",
        "supplier": "SELECT 3L AS s_suppkey, 's' AS s_name, 5L AS s_nationkey, 0.0D AS s_acctbal",
        "part": "SELECT 7L AS p_partkey, 'p' AS p_name, 'b' AS p_brand, 't' AS p_type, 1L AS p_size, 1.0D AS p_retailprice",
        "orders": "SELECT id AS o_orderkey, id % 2 + 1 AS o_custkey, IF(id < 3, 'P', 'O') AS o_orderstatus, 10.0D AS o_totalprice,"
        " IF(id > 4, timestamp'2001-01-05', timestamp'2000-12-31') AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(1, 7)",
        "lineitem": "SELECT 1L AS l_orderkey, 7L AS l_partkey, 3L AS l_suppkey, id AS l_linenumber, 1.0D AS l_quantity, 100.0D AS l_extendedprice,"
        " 0.1D AS l_discount, 0.05D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, timestamp'1998-07-01' AS l_shipdate FROM range(1, 4)",
    }
    for table, text in given.items():
        spark.sql(text).write.parquet(f"{tmp_path}/sf/{table}.parquet")
    made, found = [], []

    def folder(_, label):
        made.append(tmp_path / f"{label}-{len(made)}")
        return str(made[-1])

    def text():
        return {part for path in made for f in path.rglob("*.csv") if f.is_file() for part in f.parts if part.startswith("tpch_")}

    def watched(*args):
        found.append(text())
        return refresh(*args)

    monkeypatch.setattr(queries, "scratch_dir", folder)
    monkeypatch.setattr(queries, "refresh", watched)
    sales = rows(queries.medallion_daily_sales(spark, f"{tmp_path}/sf"), "summary_date", "total_orders", "total_revenue")
    assert sales == [("2000-12-31", 4, 60.0), ("2001-01-05", 2, 20.0)]
    assert found == [{"tpch_sf1_orders_1.csv", "tpch_sf1_part_1.csv"}, {"tpch_sf1_orders_2.csv"}]
    assert text() == set()
