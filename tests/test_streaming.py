from __future__ import annotations

import os
import time

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewater.schemas import CUSTOMER_LTV, ORDERS_SILVER, STAGING
from tidewater.streaming import ChangeFeed, follow_stage, ingest_new_files, ingest_stage, ingest_status

REGION = STAGING["region"]


def deliver(stage, number, *lines, table="region"):
    text = "r_regionkey,r_name,r_comment\n" + "".join(f"{line}\n" for line in lines)
    (stage / f"tpch_sf1_{table}_{number}.csv").write_text(text)


def load(store, stage):
    query = ingest_new_files(store, REGION, str(stage))
    query.awaitTermination()
    return query


def test_each_file_is_loaded_once(spark, store, stage):
    deliver(stage, 1, "1,A,c", "2,B,c")
    load(store, stage)
    deliver(stage, 2, "3,C,c")
    deliver(stage, 1, "99,broken", table="nation")
    query = load(store, stage)
    load(store, stage)
    table = store.read_partitioned(REGION)
    assert rows(table, "r_regionkey", "_batch_id") == [(1, 0), (2, 0), (3, 1)]
    assert {r.from_source.rsplit("/", 1)[1] for r in table.collect()} == {
        "tpch_sf1_region_1.csv",
        "tpch_sf1_region_2.csv",
    }
    assert table.filter("created_at IS NULL OR _ingested_at < created_at").isEmpty()
    status = ingest_status(query).first()
    assert (status.name, status.is_active, status.batch_id) == ("ingest_region", False, 1)


def test_ragged_rows_load_and_bad_values_fail(spark, store, stage):
    deliver(stage, 1, "1", "2,B", "3,C,c,surplus", '4,"",d', "5, pad ,")
    load(store, stage)
    assert rows(store.read(REGION), "r_regionkey", "r_name", "r_comment") == [
        (1, None, None),
        (2, "B", None),
        (3, "C", "c"),
        (4, "", "d"),
        (5, " pad ", None),
    ]
    deliver(stage, 2, "six,F,c")
    with pytest.raises(PySparkException):
        load(store, stage)
    assert store.read(REGION).count() == 5


def test_files_of_other_tables_make_no_batch(spark, store, stage):
    deliver(stage, 1, "1,A,c", table="nation")
    load(store, stage)
    assert store.read(REGION).count() == 0


def test_one_load_deals_files_to_their_tables(spark, store, stage):
    specs = list(STAGING.values())
    deliver(stage, 1, "1,A,c", "2,B,c")
    deliver(stage, 1, "5,JAPAN,1,c", table="nation")
    ingest_stage(store, specs, str(stage)).awaitTermination()
    deliver(stage, 2, "3,C,c")
    (stage / "other.txt").write_text("not,a,table\n")
    ingest_stage(store, specs, str(stage)).awaitTermination()
    ingest_stage(store, specs, str(stage)).awaitTermination()
    assert rows(store.read_partitioned(REGION), "r_regionkey", "_batch_id") == [(1, 0), (2, 0), (3, 1)]
    assert rows(store.read(STAGING["nation"]), "n_nationkey", "n_name") == [(5, "JAPAN")]
    assert os.listdir(store.control_path("ingest")) == ["stage"]
    with pytest.raises(RuntimeError):  # a load of its own would take files up again
        load(store, stage)
    with pytest.raises(RuntimeError):  # the others' files would be passed over
        ingest_stage(store, [REGION], str(stage))


def test_a_store_begun_table_by_table_goes_on_so(spark, store, stage):
    from tidewater.plans.refresh import ingest_all

    deliver(stage, 1, "1,A,c")
    load(store, stage)
    deliver(stage, 2, "2,B,c")
    ingest_all(store, str(stage))
    assert rows(store.read(REGION), "r_regionkey") == [(1,), (2,)]
    with pytest.raises(RuntimeError):
        ingest_stage(store, list(STAGING.values()), str(stage))


def test_feed_starts_after_existing_rows(spark, store, stage):
    deliver(stage, 1, "1,A,c")
    load(store, stage)
    late, full = ChangeFeed(store, REGION, "late"), ChangeFeed(store, REGION, "full")
    late.start()
    full.start(include_initial=True)
    assert (late.pending().count, full.pending().count) == (0, 1)
    deliver(stage, 2, "2,B,c", "3,C,c")
    load(store, stage)
    waiting = late.pending()
    assert waiting.count == 2
    assert rows(waiting.rows, "r_regionkey", "_action", "_is_update") == [
        (2, "INSERT", False),
        (3, "INSERT", False),
    ]
    assert late.pending().count == 2  # reading does not consume
    late.commit(waiting.upto)
    assert late.pending().count == 0
    late.start(include_initial=True)  # starting again keeps the offset
    assert late.pending().count == 0
    assert full.pending().count == 3


def test_rows_arriving_during_a_merge_stay_pending(spark, store, stage):
    feed = ChangeFeed(store, REGION, "c")
    feed.start()
    deliver(stage, 1, "1,A,c")
    load(store, stage)
    waiting = feed.pending()
    deliver(stage, 2, "2,B,c")
    load(store, stage)
    assert waiting.rows.count() == 1
    feed.commit(waiting.upto)
    assert rows(feed.pending().rows, "r_regionkey") == [(2,)]


def applied(store, stage):
    """A consumer that has applied keys 1, 2 and 3."""
    feed = ChangeFeed(store, REGION, "c")
    feed.start(include_initial=True)
    deliver(stage, 1, "1,A,c", "2,B,c", "3,C,c")
    load(store, stage)
    feed.commit(feed.pending().upto)
    return feed


def shown(feed):
    return rows(feed.pending().rows, "r_regionkey", "r_name", "_action", "_is_update")


def test_feed_shows_deletes_of_applied_rows(spark, store, stage):
    feed = applied(store, stage)
    assert store.delete_where(REGION, F.col("r_regionkey") == 2) == 1
    assert feed.pending().count == 1
    assert shown(feed) == [(2, "B", "DELETE", False)]
    feed.commit(feed.pending().upto)
    assert feed.pending().count == 0 and store.read(REGION).count() == 2


def test_feed_shows_updates_as_pairs(spark, store, stage):
    feed = applied(store, stage)
    assert store.update_where(REGION, F.col("r_regionkey") >= 2, {"r_name": F.concat("r_name", F.lit("!"))}) == 2
    assert shown(feed) == [
        (2, "B", "DELETE", True),
        (2, "B!", "INSERT", True),
        (3, "C", "DELETE", True),
        (3, "C!", "INSERT", True),
    ]
    ids = feed.pending().rows.groupBy("_row_id").count().collect()
    assert [r["count"] for r in ids] == [2, 2]


def test_feed_shows_the_net_of_several_changes(spark, store, stage):
    feed = applied(store, stage)
    deliver(stage, 2, "4,D,c", "5,E,c")
    load(store, stage)
    store.update_where(REGION, F.lit(True), {"r_name": F.concat("r_name", F.lit("!"))})
    store.update_where(REGION, F.col("r_regionkey") == 1, {"r_name": F.lit("A")})  # back to what it was
    store.delete_where(REGION, F.col("r_regionkey").isin(2, 5))  # an applied row and a new one
    assert shown(feed) == [
        (2, "B", "DELETE", False),
        (3, "C", "DELETE", True),
        (3, "C!", "INSERT", True),
        (4, "D!", "INSERT", False),
    ]
    feed.commit(feed.pending().upto)
    deliver(stage, 3, "6,F,c")
    load(store, stage)
    assert shown(feed) == [(6, "F", "INSERT", False)]


def test_feed_counts_equal_rows(spark, store):
    feed = ChangeFeed(store, REGION, "c")
    twice = spark.createDataFrame([(1, "A"), (1, "A"), (None, "N")], "r_regionkey long, r_name string")
    store.write_batch(REGION, twice, 0)
    feed.start()
    assert store.delete_where(REGION, F.col("r_name").isNotNull()) == 3
    assert feed.pending().count == 3 and store.read(REGION).count() == 0
    assert shown(feed) == [(None, "N", "DELETE", False), (1, "A", "DELETE", False), (1, "A", "DELETE", False)]


def images_of(spark, seed, hot):
    """Images of a few keys, some NULL, that came, changed and went; with ``hot``, most are of one key."""
    number = lambda c, n: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(c)), F.lit(n))
    key = F.when(number("k", 40) > 0, number("k", 40))
    return spark.range(900).select(
        (F.when(F.col("id") % 5 > 0, 7).otherwise(key) if hot else key).alias("k"),
        F.when(number("v", 3) > 0, number("v", 3)).alias("v"),
        F.when(number("w", 3) > 0, number("w", 3).cast("string")).alias("w"),
        F.when(number("a", 2) > 0, "INSERT").otherwise("DELETE").alias("_action"),
        F.lit(False).alias("_is_update"),
        F.when(number("o", 4) > 0, number("o", 4)).alias("origin"),
    )


@pytest.mark.parametrize("hot", [False, True])
def test_net_changes_against_plain_counting(spark, hot):
    from collections import Counter

    from tidewater.operators.changes import narrowed, net_changes

    images = images_of(spark, 3, hot)
    net = Counter()
    for r in images.collect():
        net[r.k, r.v, r.w, r.origin] += 1 if r._action == "INSERT" else -1
    signs = {}
    for (k, _, _, origin), n in net.items():
        signs.setdefault((k, origin), set()).add((n > 0) - (n < 0))
    want = Counter()
    for (k, v, w, origin), n in net.items():
        want[k, v, w, origin, "INSERT" if n > 0 else "DELETE", {1, -1} <= signs[k, origin]] += abs(n)
    found = net_changes(images, ["k"], "origin")
    assert Counter(tuple(r) for r in found.drop("_row_id").collect()) == +want
    # Narrowed to one column: the rest stays apart, also where a value and a NULL change places.
    few = net_changes(narrowed(images, ["k"], ["v"], ["origin"]), ["k"], "origin")
    less = Counter()
    for (k, v, _, _, action, update), n in want.items():
        less[k, v, action, update] += n
    assert Counter(tuple(r) for r in few.select("k", "v", "_action", "_is_update").collect()) == +less


def test_images_are_exchanged_once(spark, store):
    """Rows cross the network once to be netted, and only with the columns that the consumer asks for."""
    store.overwrite(ORDERS_SILVER, spark.range(4000).selectExpr("id AS o_orderkey", "'O' AS o_orderstatus"))
    feed = ChangeFeed(store, ORDERS_SILVER, "reports")
    feed.start()
    store.update_where(ORDERS_SILVER, F.col("o_orderkey") >= 0, {"o_comment": F.lit("changed")})
    whole, few = feed.pending(), feed.pending(columns=("o_custkey", "_action"))
    assert whole.count == few.count == 8000 and few.rows.columns == ["o_custkey", "_action"]
    for waiting, text in ((whole, True), (few, False)):
        plan = waiting.rows._jdf.queryExecution().executedPlan().toString()
        exchanges = [x for x in plan.splitlines() if "Exchange" in x]
        assert len(exchanges) == 1 and "hashpartitioning(o_orderkey" in exchanges[0]
        keyed = [x for x in plan.splitlines() if "HashAggregate(keys=" in x]
        assert keyed and all(("o_comment#" in x) == text for x in keyed)


def test_feed_of_a_merged_table(spark, store):
    feed = ChangeFeed(store, ORDERS_SILVER, "reports")
    one = spark.createDataFrame([(1, "O"), (2, "O")], "o_orderkey long, o_orderstatus string")
    two = spark.createDataFrame([(2, "F"), (3, "O")], "o_orderkey long, o_orderstatus string")
    store.overwrite(ORDERS_SILVER, one)
    feed.start()
    store.merge(ORDERS_SILVER, two, ["o_orderstatus"], ["o_orderstatus"])
    store.delete_where(ORDERS_SILVER, F.col("o_orderkey") == 1)
    assert rows(feed.pending().rows, "o_orderkey", "o_orderstatus", "_action", "_is_update") == [
        (1, "O", "DELETE", False),
        (2, "F", "INSERT", True),
        (2, "O", "DELETE", True),
        (3, "O", "INSERT", False),
    ]
    assert rows(store.read(ORDERS_SILVER), "o_orderkey", "o_orderstatus") == [(2, "F"), (3, "O")]
    with pytest.raises(ValueError):
        ChangeFeed(store, CUSTOMER_LTV, "nobody")


def test_merge_ignores_deletes_and_consumes_them(spark, store):
    from tidewater.plans import silver

    orders = STAGING["orders"]
    line = "o_orderkey long, o_custkey long, o_orderstatus string, o_clerk string"
    store.write_batch(orders, spark.createDataFrame([(1, 1, "O", "Clerk#1"), (2, 1, "O", "Clerk#1")], line), 0)
    silver.full_load_orders(store)
    feed = silver.ORDERS_JOB.feed(store)
    feed.start()
    store.delete_where(orders, F.col("o_orderkey") == 1)
    assert feed.pending().count == 1
    assert silver.merge_orders_cdc(store).rows_affected == 0
    assert feed.pending().count == 0 and store.read(ORDERS_SILVER).count() == 2
    store.update_where(orders, F.col("o_orderkey") == 2, {"o_orderstatus": F.lit("F")})
    assert silver.merge_orders_cdc(store).rows_affected == 1
    assert rows(store.read(ORDERS_SILVER), "o_orderkey", "o_orderstatus") == [(1, "O"), (2, "F")]


def test_net_changes_of_a_merge_are_found_once(spark, store, monkeypatch):
    from tidewater.plans import silver

    orders = STAGING["orders"]
    store.write_batch(orders, spark.createDataFrame([(1, "O"), (2, "O")], "o_orderkey long, o_orderstatus string"), 0)
    silver.full_load_orders(store)
    silver.ORDERS_JOB.feed(store).start()
    store.update_where(orders, F.col("o_orderkey") == 2, {"o_orderstatus": F.lit("F")})
    seen, merge = [], store.merge

    def watched(spec, source, *args, **kw):
        seen.extend(df._jdf.queryExecution().executedPlan().toString() for df in (source, kw["keys_from"]))
        return merge(spec, source, *args, **kw)

    monkeypatch.setattr(store, "merge", watched)
    spark.catalog.clearCache()
    assert silver.merge_orders_cdc(store).rows_affected == 1
    assert len(seen) == 2 and all("InMemoryTableScan" in plan for plan in seen)
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
    assert rows(store.read(ORDERS_SILVER), "o_orderkey", "o_orderstatus") == [(1, "O"), (2, "F")]


def test_feed_has_to_be_started(store):
    with pytest.raises(RuntimeError):
        ChangeFeed(store, REGION, "nobody").pending()


def test_following_the_stage_runs_the_job(spark, store, stage):
    seen = []
    deliver(stage, 1, "1,A,c")
    query = follow_stage(
        store, REGION, str(stage), lambda s: seen.append(s.read(REGION).count()), "1 second"
    )
    try:
        for expected in (1, 2):
            deadline = time.time() + 60
            while len(seen) < expected and time.time() < deadline:
                time.sleep(0.2)
            if expected == 1:
                deliver(stage, 2, "2,B,c")
    finally:
        query.stop()
    assert seen == [1, 2]
