"""Profiling and quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import (
    PRIORITY_DEFAULT,
    PRIORITY_RANKS,
    REVENUE_DEFAULT,
    REVENUE_TIERS,
    STATUS_DEFAULT,
    STATUS_DESCRIPTIONS,
)

# -- profiles ------------------------------------------------------------------------------------


def customers_per_country(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Distinct customers per country, largest first. Raw customers may hold several versions."""
    return (
        customer.select("c_custkey", "c_nationkey")
        .join(
            nation.select("n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
            "inner",
        )
        .groupBy(F.col("n_name").alias("country"))
        .agg(F.count_distinct("c_custkey").alias("customer_count"))
        .orderBy(F.col("customer_count").desc(), "country")
    )


def orders_by(orders: DataFrame, column: str, unique_keys: bool = False) -> DataFrame:
    """Distinct orders per value of a status column (raw code or description).

    In a table whose keys are unique (the cleaned orders) a plain count is the distinct count, and
    only one row per status and task is shuffled.
    """
    counted = F.count("o_orderkey") if unique_keys else F.count_distinct("o_orderkey")
    return orders.groupBy(column).agg(counted.alias("order_count"))


def load_probe(staged: DataFrame, key: str, from_key: int) -> DataFrame:
    """Rows from a key on with where and when they were loaded, newest first."""
    return (
        staged.filter(F.col(key) >= from_key)
        .select(key, "created_at", "from_source")
        .orderBy(F.col("created_at").desc_nulls_first(), key)
    )


def top_part_types(lineitem: DataFrame, rows: int = 10) -> DataFrame:
    """Part types on the most distinct orders; ties by name."""
    return (
        lineitem.groupBy("l_part_type")
        .agg(F.count_distinct("l_orderkey").alias("order_count"))
        .orderBy(F.col("order_count").desc(), "l_part_type")
        .limit(rows)
    )


def monthly_status_profile(orders: DataFrame, since: date = date(1995, 1, 1)) -> DataFrame:
    return (
        orders.filter(F.col("o_orderdate") >= F.lit(since))
        .groupBy("o_order_year", "o_order_month", "o_orderstatus_desc")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("o_totalprice").alias("total_revenue"),
            F.avg("o_totalprice").alias("avg_order_value"),
            F.count_distinct("o_custkey").alias("unique_customers"),
        )
        .orderBy("o_order_year", "o_order_month", "o_orderstatus_desc")
    )


# -- checks --------------------------------------------------------------------------------------


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _stacked(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def null_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs per column; each table is read once, whatever its number of columns."""
    parts = []
    for name, df in tables.items():
        counted = df.agg(
            *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns]
        )
        parts.append(
            counted.unpivot([], counted.columns, "column_name", "null_count").select(
                F.lit(name).alias("table_name"), "column_name", "null_count"
            )
        )
    return _stacked(parts)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def key_uniqueness(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table: keys that are not unique and the rows to remove to make them so."""
    return _stacked(
        [
            duplicate_keys(df, keys)
            .agg(
                F.count(F.lit(1)).alias("duplicate_keys"),
                F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("surplus_rows"),
            )
            .select(F.lit(name).alias("table_name"), "duplicate_keys", "surplus_rows")
            for name, (df, keys) in tables.items()
        ]
    )


# Values each derived column may take.
STATUS_DOMAIN = [text for _, text in STATUS_DESCRIPTIONS] + [STATUS_DEFAULT]
RANK_DOMAIN = [rank for _, rank in PRIORITY_RANKS] + [PRIORITY_DEFAULT]
TIER_DOMAIN = [tier for _, tier in REVENUE_TIERS] + [REVENUE_DEFAULT]


def _outside(column: str, domain: Sequence) -> Column:
    return F.col(column).isNull() | ~F.col(column).isin(list(domain))


def order_rules() -> dict[str, Column]:
    return {
        "order status description in domain": _outside("o_orderstatus_desc", STATUS_DOMAIN),
        "order priority rank in domain": _outside("o_priority_rank", RANK_DOMAIN),
        "order date parts agree with date": (
            (F.col("o_order_year") != F.year("o_orderdate"))
            | (F.col("o_order_month") != F.month("o_orderdate"))
            | (F.col("o_order_quarter") != F.quarter("o_orderdate"))
        ),
    }


def lineitem_rules() -> dict[str, Column]:
    return {
        "ship delay not negative": F.col("l_ship_delay_days") < 0,
        "net price not above extended price": F.col("l_net_price") > F.col("l_extendedprice"),
        "final price not below net price": F.col("l_final_price") < F.col("l_net_price"),
    }


def ltv_rules() -> dict[str, Column]:
    return {
        "customer tier in domain": _outside("customer_tier", TIER_DOMAIN),
        "first order not after last order": F.col("first_order_date") > F.col("last_order_date"),
    }


def rule_violations(checks: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """Rows breaking each rule; every table is read once for all its rules."""
    parts = []
    for name, (df, rules) in checks.items():
        counted = df.agg(*[F.count(F.when(bad, 1)).alias(rule) for rule, bad in rules.items()])
        parts.append(
            counted.unpivot([], [F.col(f"`{rule}`") for rule in rules], "rule", "violations").select(
                F.lit(name).alias("table_name"), "rule", "violations"
            )
        )
    return _stacked(parts)
