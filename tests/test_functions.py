from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from tidewater.functions import (
    clamp_negative,
    classify_customer_revenue,
    classify_orderstatus,
    classify_priority_rank,
    clerk_id,
    register_functions,
    right_chars,
    uniform_int,
    validate_email,
    validate_phone_number,
    zero_padded,
)

REVENUE = [
    (500000.0, "VIP"),
    (499999.99, "GOLD"),
    (100000.0, "GOLD"),
    (99999.99, "SILVER"),
    (10000.0, "SILVER"),
    (9999.99, "STANDARD"),
    (-1.0, "STANDARD"),
    (None, "STANDARD"),
]
STATUS = [
    ("F", "FINISHED"),
    ("O", "OPEN"),
    ("P", "PENDING"),
    ("X", "UNKNOWN"),
    ("f", "UNKNOWN"),
    (None, "UNKNOWN"),
]
PRIORITY = [
    ("1-URGENT", 1),
    ("1-URGENT extra", 1),
    ("2-HIGH", 2),
    ("3-MEDIUM", 3),
    ("4-NOT SPECIFIED", 4),
    ("4-NOT", 9),
    ("5-LOW", 5),
    ("6-X", 9),
    (None, 9),
]
PHONES = [
    ("123456789", False),
    ("1234567890", True),
    ("123456789012345", True),
    ("1234567890123456", False),
    ("  1234567890  ", True),
    ("+1234567890", False),
    ("1234567890\n", False),
    (None, None),
]
EMAILS = [
    ("a@b.c", True),
    ("a@b", False),
    ("a b@c.d", False),
    ("  a@b.c ", True),
    ("a@b.c\n", False),
    (None, None),
]


def frame(spark, cases, kind):
    return spark.createDataFrame(
        [(i, value) for i, (value, _) in enumerate(cases)], f"i int, v {kind}"
    )


@pytest.mark.parametrize(
    "function, name, cases, kind",
    [
        (classify_customer_revenue, "classify_customer_revenue", REVENUE, "double"),
        (classify_orderstatus, "classify_orderstatus", STATUS, "string"),
        (classify_priority_rank, "classify_priority_rank", PRIORITY, "string"),
        (validate_phone_number, "validate_phone_number", PHONES, "string"),
        (validate_email, "validate_email", EMAILS, "string"),
    ],
)
def test_rules_as_column_and_as_sql_function(spark, function, name, cases, kind):
    register_functions(spark)
    df = frame(spark, cases, kind)
    got = df.select("i", function(F.col("v")).alias("a"), F.expr(f"{name}(v)").alias("b"))
    expected = [wanted for _, wanted in cases]
    ordered = got.orderBy("i").collect()
    assert [r.a for r in ordered] == expected
    assert [r.b for r in ordered] == expected


def test_clerk_id(spark):
    cases = [("Clerk#000000951", 951), ("a1b22", 1), ("Clerk#none", None), (None, None)]
    got = frame(spark, cases, "string").orderBy("i").select(clerk_id(F.col("v")).alias("x"))
    assert [r.x for r in got.collect()] == [None if w is None else Decimal(w) for _, w in cases]


def test_a_clerk_number_that_does_not_fit_is_an_error(spark):
    with pytest.raises(ArithmeticException):
        frame(spark, [("Clerk#1234567890123", None)], "string").select(clerk_id(F.col("v"))).collect()


def test_clamp_keeps_null(spark):
    cases = [(-3, 0), (0, 0), (4, 4), (None, None)]
    got = frame(spark, cases, "int").orderBy("i").select(clamp_negative(F.col("v")).alias("x"))
    assert [r.x for r in got.collect()] == [w for _, w in cases]


def test_text_helpers(spark):
    row = spark.range(1).select(
        zero_padded(F.lit(42), 9).alias("short"),
        zero_padded(F.lit(12345678901), 9).alias("long"),
        right_chars(F.lit("abcdef"), 4).alias("end"),
    )
    assert tuple(row.first()) == ("000000042", "123456789", "cdef")


def test_uniform_int_stays_in_range_and_repeats(spark):
    ids = spark.range(5000).select("id", uniform_int(3, 12, F.col("id")).alias("u"))
    values = {r.id: r.u for r in ids.collect()}
    assert set(values.values()) == set(range(3, 13))
    assert values == {r.id: r.u for r in ids.repartition(7).collect()}
    other = ids.select("id", uniform_int(3, 12, F.col("id"), seed=1).alias("u"))
    assert values != {r.id: r.u for r in other.collect()}
