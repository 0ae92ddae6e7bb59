from __future__ import annotations

import pytest
from conftest import rows

from tidewater.operators import latest_per_key
from tidewater.operators.dedup import evenly_dealt

DATA = [
    (1, "old", "2024-01-01"),
    (1, "new", "2024-02-01"),
    (2, "stamped", "2024-02-01"),
    (2, "bare", None),
    (3, "tie b", "2024-01-01"),
    (3, "tie a", "2024-01-01"),
    (4, "single", None),
    (None, "null key a", "2024-01-01"),
    (None, "null key b", "2024-01-02"),
]


def frame(spark):
    return spark.createDataFrame(DATA, "k int, v string, created_at string").selectExpr(
        "k", "v", "cast(created_at as timestamp) created_at"
    )


@pytest.mark.parametrize("nulls, second", [("first", "bare"), ("last", "stamped")])
def test_newest_version_wins(spark, nulls, second):
    got = rows(latest_per_key(frame(spark), ["k"], nulls=nulls), "k", "v")
    assert got == sorted(
        [(None, "null key b"), (1, "new"), (2, second), (3, "tie a"), (4, "single")],
        key=lambda t: [(v is not None, str(v)) for v in t],
    )


def test_result_does_not_depend_on_row_placement(spark):
    once = rows(latest_per_key(frame(spark), ["k"]))
    assert once == rows(latest_per_key(frame(spark).repartition(5), ["k"]))


def test_rank_column_and_bad_argument(spark):
    assert {r._rank for r in latest_per_key(frame(spark), ["k"], keep_rank=True).collect()} == {1}
    with pytest.raises(ValueError):
        latest_per_key(frame(spark), ["k"], nulls="middle")


def test_composite_key(spark):
    df = spark.createDataFrame(
        [(1, 1, 1), (1, 1, 2), (1, 2, 1)], "a int, b int, created_at int"
    )
    assert rows(latest_per_key(df, ["a", "b"])) == [(1, 1, 2), (1, 2, 1)]


def test_versions_are_cut_before_the_shuffle(spark):
    """A key with very many versions sends at most one row per map task."""
    plan = latest_per_key(frame(spark), ["k"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    shuffle = physical.index("Exchange hashpartitioning")
    assert physical.index("Partial", shuffle) > shuffle  # printed below, so executed before
    assert "WindowGroupLimit" in physical[shuffle:]


def test_a_key_with_many_versions_is_not_evenly_dealt(spark):
    unique = spark.range(10000).selectExpr("id a", "id % 7 b")
    assert evenly_dealt(unique, ["a", "b"], 8)
    assert evenly_dealt(unique.where("false"), ["a", "b"], 8)
    assert not evenly_dealt(unique.selectExpr("if(a % 3 = 0, 1, a) a", "1 b"), ["a", "b"], 8)
    assert not evenly_dealt(unique.selectExpr("nullif(a, a) a", "1 b"), ["a", "b"], 8)
