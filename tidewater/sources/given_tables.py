"""Test data in the shape of the staging tables.

The given tables lack some staging columns and hold money as double and dates as timestamps. The
missing columns are filled by fixed formulas of the key, which the SQL checks repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import STAGING


def read_given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loaded_at(key: str) -> Column:
    """Load stamp on one of five days; every 13th key has none, like a bulk-loaded row."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col(key) % 5).cast("int"))
    return F.when(F.col(key) % 13 != 0, day.cast("timestamp"))


def _days(base: str, shift: Column) -> Column:
    return F.date_add(F.to_date(base), shift.cast("int"))


def _note(kind: str, key: str) -> Column:
    """A comment holding the delimiter and the quote character, so that files must quote it."""
    text = F.concat(F.lit(f'{kind} "'), F.col(key).cast("string"), F.lit('", given'))
    return F.when(F.col(key) % 11 != 0, text)


def _region(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"r_comment": _note("region", "r_regionkey"), "created_at": loaded_at("r_regionkey")}
    )


def _nation(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"n_comment": _note("nation", "n_nationkey"), "created_at": loaded_at("n_nationkey")}
    )


def _customer(df: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return df.withColumns(
        {
            "c_address": F.concat(F.lit("addr "), key.cast("string")),
            "c_phone": F.when(
                key % 3 == 0, F.concat(F.lit("15-"), (key + 1000000).cast("string"))
            ).otherwise((key * 7919 + 1000000000).cast("string")),
            "c_comment": _note("customer", "c_custkey"),
            "created_at": loaded_at("c_custkey"),
        }
    )


def _supplier(df: DataFrame) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    return df.withColumns(
        {
            "s_address": F.concat(F.lit("addr "), key),
            "s_phone": F.concat(F.lit("25-"), key),
            "s_comment": _note("supplier", "s_suppkey"),
            "created_at": loaded_at("s_suppkey"),
        }
    )


def _part(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "p_mfgr": F.concat(F.lit("Maker#"), (F.col("p_partkey") % 5).cast("string")),
            "p_container": F.when(F.col("p_size") > 25, "JUMBO BOX").otherwise("SM CASE"),
            "p_comment": F.concat(F.lit("part "), F.col("p_partkey").cast("string")),
            "created_at": loaded_at("p_partkey"),
        }
    )


def _orders(df: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    clerk = (
        F.when(key % 97 == 0, F.lit(None).cast("string"))
        .when(key % 89 == 0, F.lit("Clerk#none"))
        .otherwise(F.concat(F.lit("Clerk#"), F.lpad((key % 1000).cast("string"), 9, "0")))
    )
    return df.withColumns(
        {
            "o_orderdate": F.to_date("o_orderdate"),
            "o_clerk": clerk,
            "o_shippriority": F.lit(0),
            "o_comment": _note("order", "o_orderkey"),
            "created_at": loaded_at("o_orderkey"),
        }
    )


def _lineitem(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "l_commitdate": _days("l_shipdate", F.col("l_partkey") % 61 - 30),
            "l_receiptdate": _days("l_shipdate", F.col("l_suppkey") % 30 + 1),
            "l_shipdate": F.to_date("l_shipdate"),
            "l_shipinstruct": F.when(F.col("l_linenumber") % 2 == 0, "NONE").otherwise("COLLECT COD"),
            "l_shipmode": F.when(F.col("l_suppkey") % 2 == 0, "AIR").otherwise("RAIL"),
            "l_comment": _note("line", "l_linenumber"),
            "created_at": loaded_at("l_orderkey"),
        }
    )


def _partsupp(lineitem: DataFrame) -> DataFrame:
    part, supp = F.col("ps_partkey"), F.col("ps_suppkey")
    pairs = lineitem.select(
        F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")
    ).distinct()
    return pairs.withColumns(
        {
            "ps_availqty": (part * 31 + supp * 17) % 9999 + 1,
            "ps_supplycost": (part * 13 + supp * 7) % 1000 + 1,
            "ps_comment": _note("pair", "ps_partkey"),
            "created_at": loaded_at("ps_partkey"),
        }
    )


_SHAPES = {
    "region": _region,
    "nation": _nation,
    "customer": _customer,
    "supplier": _supplier,
    "part": _part,
    "orders": _orders,
    "lineitem": _lineitem,
    "partsupp": _partsupp,
}


def staging_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table with all staging columns, in declared order and type."""
    given = read_given(spark, sf_dir, "lineitem" if name == "partsupp" else name)
    shaped = _SHAPES[name](given)
    return shaped.select(
        *[
            (F.col(f.name) if f.name in shaped.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in STAGING[name].read_schema
        ]
    )
