from __future__ import annotations

from conftest import rows

from tidewater.operators import append_feed, keep_inserts, newest_changes, pending_count, table_changes

SCHEMA = "k int, v string, created_at int"


def feed(spark, before, after):
    return table_changes(
        spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA), ["k"]
    )


def test_insert_update_delete_unchanged(spark):
    changes = feed(
        spark,
        [(1, "same", 1), (2, "old", 1), (3, "gone", 1), (4, None, 1), (None, "n", 1)],
        [(1, "same", 1), (2, "new", 2), (4, "set", 1), (5, "added", 3), (None, "n", 1)],
    )
    assert rows(changes, "k", "v", "_action", "_is_update") == [
        (2, "new", "INSERT", True),
        (2, "old", "DELETE", True),
        (3, "gone", "DELETE", False),
        (4, None, "DELETE", True),
        (4, "set", "INSERT", True),
        (5, "added", "INSERT", False),
    ]
    assert pending_count(changes) == 6
    assert rows(keep_inserts(changes), "k", "v") == [(2, "new"), (4, "set"), (5, "added")]
    assert [r.k for r in newest_changes(changes, ["k"]).collect()][0] == 5


def test_row_id_survives_an_update(spark):
    changes = feed(spark, [(1, "a", 1), (2, "x", 1)], [(1, "b", 1), (2, "y", 1)])
    ids = {(r.k, r._action): r._row_id for r in changes.collect()}
    assert ids[1, "DELETE"] == ids[1, "INSERT"] != ids[2, "INSERT"]


def test_equal_snapshots_give_nothing(spark):
    data = [(1, None, None), (2, "x", 2)]
    assert feed(spark, data, data).isEmpty()


def test_appended_rows_are_inserts(spark):
    df = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    assert rows(append_feed(df, ["k"]), "k", "_action", "_is_update") == [(1, "INSERT", False)]
