from __future__ import annotations

from datetime import date, datetime

from conftest import rows
from pyspark.sql import functions as F

from tidewater.operators import deactivate_stale, delete_where, upsert

TARGET = "k int, v string, note string, first string, stamp string"
SOURCE = "k int, v string, note string, first string"


def merge(spark, target, source):
    return upsert(
        spark.createDataFrame(target, TARGET),
        spark.createDataFrame(source, SOURCE),
        ["k"],
        update=["v", "note"],
        insert=["v", "note", "first"],
        on_update={"stamp": F.lit("now")},
        on_insert={"stamp": F.lit("now")},
    )


OLD = [(1, "a", "n1", "f1", "then"), (2, "b", None, "f2", "then")]


def test_insert_update_keep(spark):
    got = rows(merge(spark, OLD, [(2, "B", "n2", "ignored"), (3, "c", None, "f3")]))
    assert got == [
        (1, "a", "n1", "f1", "then", "kept"),
        (2, "B", "n2", "f2", "now", "updated"),
        (3, "c", None, "f3", "now", "inserted"),
    ]


def test_a_source_null_overwrites(spark):
    got = rows(merge(spark, OLD, [(1, None, None, "x")]))
    assert got[0] == (1, None, None, "f1", "now", "updated")


def test_null_key_never_matches(spark):
    got = rows(merge(spark, [(None, "a", None, "f", "then")], [(None, "b", None, "g")]))
    assert got == [
        (None, "a", None, "f", "then", "kept"),
        (None, "b", None, "g", "now", "inserted"),
    ]


def test_empty_sides(spark):
    assert [r[-1] for r in rows(merge(spark, OLD, []))] == ["kept", "kept"]
    assert [r[-1] for r in rows(merge(spark, [], [(1, "a", "b", "c")]))] == ["inserted"]
    assert rows(merge(spark, [], [])) == []


def test_same_batch_twice_changes_nothing(spark):
    batch = [(2, "B", "n2", "x"), (3, "c", None, "f3")]
    once = merge(spark, OLD, batch).drop("_merge")
    twice = merge(spark, [tuple(r) for r in once.collect()], batch).drop("_merge")
    assert rows(once) == rows(twice)


def test_columns_left_out_of_the_insert_are_null(spark):
    got = upsert(
        spark.createDataFrame([], TARGET),
        spark.createDataFrame([(1, "a", "b", "c")], SOURCE),
        ["k"],
        update=[],
        insert=["v"],
    )
    assert rows(got) == [(1, "a", None, None, None, "inserted")]


def test_deactivation_boundaries(spark):
    as_of = date(1998, 9, 2)
    data = [
        (1, date(1998, 6, 4), True),  # exactly 90 days before
        (2, date(1998, 6, 3), True),  # 91 days before
        (3, None, True),
        (4, date(1990, 1, 1), False),
    ]
    before = datetime(2024, 1, 1)
    ltv = spark.createDataFrame(
        [(*r, before) for r in data],
        "k int, last_order_date date, is_active boolean, load_timestamp timestamp",
    )
    now = datetime(2025, 1, 1)
    got = deactivate_stale(ltv, F.lit(as_of), now=F.lit(now)).orderBy("k").collect()
    assert [(r.k, r.is_active, r.load_timestamp == now) for r in got] == [
        (1, True, False),
        (2, False, True),
        (3, True, False),
        (4, False, False),
    ]


def test_delete_keeps_rows_whose_condition_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, None)], "k int, v int")
    assert rows(delete_where(df, F.col("v") > 10)) == [(1, 5), (3, None)]


def test_blocks_of_the_repeated_merge_are_found_without_cleaning(spark, tmp_path, monkeypatch):
    from tidewater.operators.store import TableStore
    from tidewater.verification.queries import write_then_read_by_name

    day = "timestamp '2001-03-01'"
    orders = f"id AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, 5.0D AS o_totalprice, {day} AS o_orderdate, '1-URGENT' AS o_orderpriority"
    spark.range(3).selectExpr(*orders.split(", ")).write.parquet(str(tmp_path / "orders.parquet"))
    plans, merge = [], TableStore.merge

    def watched(self, spec, source, *args, keys_from=None, **kw):
        keys = source if keys_from is None else keys_from
        plans.append(keys.select(*spec.keys)._jdf.queryExecution().executedPlan().toString())
        return merge(self, spec, source, *args, keys_from=keys_from, **kw)

    monkeypatch.setattr(TableStore, "merge", watched)
    found = {(r.phase, r.o_orderstatus_desc, r.order_count) for r in write_then_read_by_name(spark, str(tmp_path)).collect()}
    assert found == {("repeated", "OPEN", 3)}
    assert len(plans) == 2 and not any("Window" in plan for plan in plans)
