from __future__ import annotations

import os
import re
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators import store as store_module
from tidewater.operators.store import TableStore
from tidewater.operators.versions import Versions
from tidewater.schemas import CUSTOMER_LTV, CUSTOMER_SENSITIVE, ORDERS_SILVER, STAGING, key_range_block
from tidewater.sources.catalog import register_tables

SPEC = replace(CUSTOMER_LTV, block=key_range_block("c_custkey", 2))


def ltv(spark, keys, name="n", active=True):
    return spark.createDataFrame(
        [(k, f"{name}{k}", active) for k in keys], "c_custkey bigint, c_name string, is_active boolean"
    )


def merge(store, source, **kw):
    return store.merge(SPEC, source, update=["c_name"], insert=["c_name", "is_active"], **kw)


def files(store, spec=SPEC):
    """Files that readers of the table open, and the block of each."""
    table = store.spark.table(store.table_name(spec))
    return {r[0]: r[1] for r in table.select("_metadata.file_path", spec.partition_column).distinct().collect()}


def test_absent_table_is_empty_and_created_table_has_its_columns(store):
    assert store.read(SPEC).columns == SPEC.columns.names
    store.create(SPEC)
    assert store.read(SPEC).count() == 0


def test_merge_rewrites_only_touched_blocks(spark, store):
    store.overwrite(SPEC, ltv(spark, range(12)))
    before = files(store)
    counts = merge(store, ltv(spark, [5, 20], "m"))
    assert (counts.inserted, counts.updated) == (1, 1)
    after = files(store)
    kept = {f for f, block in before.items() if block != 1}
    assert kept <= set(after)
    assert {b for f, b in after.items() if f not in before} == {1, 5}
    names = dict(rows(store.read(SPEC), "c_custkey", "c_name"))
    assert len(names) == 13 and names[5] == "m5" and names[20] == "m20" and names[4] == "n4"


def test_merge_twice_and_without_source(spark, store):
    assert merge(store, ltv(spark, [])).affected == 0
    assert merge(store, ltv(spark, [1, 2])).inserted == 2
    once = rows(store.read(SPEC))
    assert merge(store, ltv(spark, [1, 2])).updated == 2
    assert rows(store.read(SPEC)) == once


def test_null_key_block(spark, store):
    merge(store, ltv(spark, [None, 1]))
    assert merge(store, ltv(spark, [None])).inserted == 1
    assert [r[0] for r in rows(store.read(SPEC), "c_custkey")] == [None, None, 1]


def test_many_touched_blocks(spark, store):
    store.overwrite(SPEC, ltv(spark, range(40)))
    counts = merge(store, ltv(spark, range(0, 50, 2), "m"))
    assert (counts.inserted, counts.updated) == (5, 20)
    names = dict(rows(store.read(SPEC), "c_custkey", "c_name"))
    assert len(names) == 45 and names[0] == "m0" and names[1] == "n1" and names[48] == "m48"
    assert store.update_where(SPEC, F.col("c_custkey") < 30, {"is_active": F.lit(False)}) == 30
    assert store.delete_where(SPEC, F.col("c_custkey") >= 0) == 45
    assert store.read(SPEC).count() == 0


def test_update_where(spark, store):
    store.overwrite(SPEC, ltv(spark, range(10)))
    before = files(store)
    assert store.update_where(SPEC, F.col("c_custkey") == 9, {"is_active": F.lit(False)}) == 1
    assert rows(store.read(SPEC).filter("not is_active"), "c_custkey") == [(9,)]
    assert {f for f, b in before.items() if b != 2} <= set(files(store))
    assert store.update_where(SPEC, F.col("c_custkey") > 99, {"is_active": F.lit(False)}) == 0


def test_delete_empties_a_block(spark, store):
    store.overwrite(SPEC, ltv(spark, range(10)))
    assert store.delete_where(SPEC, F.col("c_custkey").between(3, 7)) == 5
    assert rows(store.read(SPEC), "c_custkey") == [(0,), (1,), (2,), (8,), (9,)]
    assert store.delete_where(SPEC, F.lit(None).cast("boolean")) == 0


def test_repeated_batch_replaces_itself(spark, store):
    spec = STAGING["region"]
    one = spark.createDataFrame([(1, "A")], "r_regionkey int, r_name string")
    store.write_batch(spec, one, 0)
    store.write_batch(spec, one, 0)
    store.write_batch(spec, one, 1)
    assert store.read(spec).count() == 2


def test_loads_without_the_added_columns_read_as_null(spark, store):
    spec = STAGING["region"]
    old = spark.createDataFrame([(1, "A", "c")], "r_regionkey bigint, r_name string, r_comment string")
    store.write_batch(spec, old, -1)
    store.write_batch(spec, old.withColumn("from_source", F.lit("f")), 0)
    assert rows(store.read(spec), "r_regionkey", "from_source", "created_at") == [
        (1, None, None),
        (1, "f", None),
    ]


def lost(*_args, **_more):
    raise OSError("driver lost")


MERGED = [(k, f"{'m' if k in (1, 5) else 'n'}{k}") for k in range(12)] + [(None, "mNone")]


def names_in(store):
    return sorted((tuple(r) for r in store.read(SPEC).select("c_custkey", "c_name").collect()), key=str)


@pytest.mark.parametrize("at", ["catalog", "offset"])
def test_a_committed_merge_is_shown_once(spark, store, monkeypatch, at):
    """The driver goes after the commit: before the catalog changes, or before the consumer's offset."""
    store.overwrite(SPEC, ltv(spark, range(12)))
    before = names_in(store)
    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "_show" if at == "catalog" else "commit_offset", lost)
        with pytest.raises(OSError):
            merge(store, ltv(spark, [1, 5, None], "m"), offset=("consumer", 7))
    assert names_in(store) == (before if at == "catalog" else sorted(MERGED, key=str))
    store.recover(SPEC)
    store.recover(SPEC)
    assert names_in(store) == sorted(MERGED, key=str)
    assert {r[0] for r in spark.read.parquet(store.control_path("offsets/consumer")).select("upto").collect()} == {7}


def test_readers_see_no_gap_while_the_catalog_changes(spark, store, monkeypatch):
    """After each statement that changes the catalog, every key is there once."""
    store.overwrite(SPEC, ltv(spark, range(12)))
    seen, run = [], type(spark).sql

    def watched(session, text, *args, **more):
        out = run(session, text, *args, **more)
        if text.startswith("ALTER TABLE"):
            seen.append(sorted(r[0] for r in run(session, f"SELECT c_custkey FROM {store.table_name(SPEC)}").collect()))
        return out

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", watched)
        merge(store, ltv(spark, [0, 5, 9], "m"))
        store.overwrite(SPEC, ltv(spark, range(12), "w"))
    assert len(seen) > 6 and all(keys == list(range(12)) for keys in seen)


def test_a_whole_write_and_a_delete_are_shown_after_a_loss(spark, store, monkeypatch):
    store.overwrite(SPEC, ltv(spark, range(10)))
    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "_show", lost)
        with pytest.raises(OSError):
            store.delete_where(SPEC, F.col("c_custkey").between(3, 7))
    assert merge(store, ltv(spark, [20])).inserted == 1
    assert sorted(r.c_custkey for r in store.read(SPEC).collect()) == [0, 1, 2, 8, 9, 20]
    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "_show", lost)
        with pytest.raises(OSError):
            store.overwrite(SPEC, ltv(spark, [30]))
    store.recover(SPEC)
    assert rows(store.read(SPEC), "c_custkey") == [(30,)]


def test_write_that_was_not_committed_leaves_the_table(spark, store, monkeypatch):
    store.overwrite(SPEC, ltv(spark, range(4)))
    with monkeypatch.context() as patch:
        patch.setattr(Versions, "commit", lost)
        with pytest.raises(OSError):
            store.overwrite(SPEC, ltv(spark, [9]))
    assert os.path.isdir(store.versions(SPEC).folder(1))
    store.recover(SPEC)
    assert rows(store.read(SPEC), "c_custkey") == [(0,), (1,), (2,), (3,)]
    assert not os.path.isdir(store.versions(SPEC).folder(1))
    merge(store, ltv(spark, [9]))  # the lost write's number is not used again
    assert [(v, kind) for v, _, kind, _ in store.versions(SPEC).listed()] == [(0, "whole"), (1, "void"), (2, "rows")]


def test_a_new_catalog_is_filled_from_the_commits(spark, store):
    store.overwrite(SPEC, ltv(spark, range(12)))
    merge(store, ltv(spark, [5, 20], "m"))
    store.delete_where(SPEC, F.col("c_custkey") < 4)
    want = names_in(store)
    spark.conf.set("spark.sql.shuffle.partitions", "7")  # the table keeps its buckets
    try:
        spark.sql(f"DROP DATABASE {store.database} CASCADE")
        again = TableStore(spark, store.root)
        assert names_in(again) == want
        assert merge(again, ltv(spark, [6, 30], "z")).updated == 1
        assert len(names_in(again)) == len(want) + 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_vacuum_keeps_what_readers_open(spark, store):
    store.overwrite(SPEC, ltv(spark, range(12)))
    merge(store, ltv(spark, [5], "m"))
    merge(store, ltv(spark, [5, 9], "x"))
    want, used = names_in(store), set(files(store))
    assert store.vacuum(SPEC) == 3  # blocks 1 and 2 of the first write, block 1 of the second
    assert names_in(store) == want and set(files(store)) == used
    assert store.vacuum(SPEC) == 0


def test_a_merge_exchanges_its_batch_alone(spark, store):
    """No exchange between the table's files and the join, and none between the join and the files written."""
    store.overwrite(SPEC, ltv(spark, range(12)))
    batch = spark.range(40).selectExpr("id AS c_custkey", "'b' AS c_name", "true AS is_active")
    joined = store.merged(SPEC, batch, [0, 1, 2], ["c_name"], ["c_name", "is_active"])
    plan = store._rows_only(SPEC, joined)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    lines = [x for x in plan.splitlines() if x.strip()]
    exchanges = [x for x in lines if "Exchange" in x]
    assert len(exchanges) == 1 and "c_custkey" in exchanges[0] and "hashpartitioning" in exchanges[0]
    join = next(i for i, x in enumerate(lines) if "Join" in x)
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x)
    at = lines.index(exchanges[0])
    assert at > join and at > scan and "Bucketed: true" in lines[scan] and "PartitionFilters: [" in lines[scan]
    merge(store, batch)
    written = files(store)
    assert len(written) <= 4 * len(set(written.values()))  # a file for each bucket of a block


def test_staging_delete(spark, store):
    spec = STAGING["region"]
    for batch in (0, 1):
        df = spark.createDataFrame([(batch * 10 + i, "A") for i in range(3)], "r_regionkey long, r_name string")
        store.write_batch(spec, df, batch)
    assert store.delete_where(spec, F.col("r_regionkey") >= 10) == 3
    assert rows(store.read_partitioned(spec), "r_regionkey", "_batch_id") == [(0, 0), (1, 0), (2, 0)]


def test_sensitive_table_is_not_registered(store):
    with pytest.raises(PermissionError):
        register_tables(store, [CUSTOMER_SENSITIVE])


def test_overwrite_drops_old_blocks_in_any_session_mode(spark, store):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store.overwrite(SPEC, ltv(spark, [1]))
        store.overwrite(SPEC, ltv(spark, [30]))
        assert [r[0] for r in rows(store.read(SPEC), "c_custkey")] == [30]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_batch_numbers_are_kept_and_never_reused(spark, store):
    spec = STAGING["region"]
    assert [store.batch_number(spec, "a", 0), store.batch_number(spec, "a", 1)] == [0, 1]
    assert store.batch_number(spec, "b", 0) == 2
    assert [store.batch_number(spec, "a", 1), store.batch_number(spec, "b", 0)] == [1, 2]


def test_tables_by_name(spark, store):
    store.overwrite(SPEC, ltv(spark, range(10)))
    try:
        assert register_tables(store, [SPEC, STAGING["region"]]) == [
            "reports.customer_ltv",
            "staging.region",
        ]
        assert spark.table("reports.customer_ltv").count() == 10
        assert spark.table("staging.region").count() == 0
        merge(store, ltv(spark, [100]))
        assert spark.sql("SELECT count(*) FROM reports.customer_ltv").first()[0] == 11
    finally:
        for name in ("reports", "staging"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    assert store.read(SPEC).count() == 11


def test_clustered_layout_skips_files(spark, tmp_path):
    path = str(tmp_path / "clustered")
    df = spark.range(10000).selectExpr("id % 100 AS d", "id")
    store_module.write_clustered(df, path, ["d", "id"], partitions=10)
    back = spark.read.parquet(path)
    assert back.count() == 10000
    spans = back.groupBy(F.input_file_name()).agg(F.min("d").alias("a"), F.max("d").alias("b"))
    assert all(r.b - r.a < 20 for r in spans.collect())


def test_ansi_is_required(spark):
    from tidewater.session import require_ansi

    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError):
            require_ansi(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_many_narrow_blocks_get_no_buckets(spark, store):
    """Buckets would make several files of each block's few keys; the merge is the same without them."""
    keys = spark.range(1200).selectExpr("id AS c_custkey", "concat('n', id) AS c_name", "true AS is_active")
    store.overwrite(SPEC, keys)
    merge(store, keys.where("c_custkey % 2 = 0 OR c_custkey > 1190").selectExpr("c_custkey + 4 AS c_custkey", "'m' AS c_name", "is_active"))
    written = files(store)
    assert len(written) == len(set(written.values())) == 301
    names = dict(rows(store.read(SPEC), "c_custkey", "c_name"))
    assert len(names) == 1204 and names[3] == "n3" and names[6] == "m" and names[1203] == "m"
    assert TableStore(spark, store.root)._buckets(SPEC) == 0


def test_images_are_made_in_compiled_code(spark, store):
    spec = replace(ORDERS_SILVER, columns=StructType([f for f in ORDERS_SILVER.columns if f.name in ("o_orderkey", "o_orderstatus")]))
    old = "struct(id AS o_orderkey, 'O' AS o_orderstatus)"
    flag = "element_at(array('kept', 'updated', 'inserted', 'deleted'), cast(id + 1 AS int))"
    flagged = spark.range(4).selectExpr(
        "id AS o_orderkey", "'F' AS o_orderstatus", f"IF(id IN (1, 3), {old}, NULL) AS _before", f"{flag} AS _merge", "0L AS key_block"
    )
    copies = store._images(spec, flagged)
    assert rows(copies, "o_orderkey", "o_orderstatus", "_kind", "_action", "_is_update") == [
        (0, "F", "rows", None, None),
        (1, "F", "images", "INSERT", True),
        (1, "F", "rows", None, None),
        (1, "O", "images", "DELETE", True),
        (2, "F", "images", "INSERT", False),
        (2, "F", "rows", None, None),
        (3, "O", "images", "DELETE", False),
    ]
    assert re.search(r"\*\(\d+\) Generate explode", copies._jdf.queryExecution().executedPlan().toString())
