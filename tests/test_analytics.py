from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import pytest
from conftest import rows

from tidewater.operators import exact_quantiles
from tidewater.operators import quantiles as quantiles_module
from tidewater.plans import analytics

D = Decimal


def amounts(spark, values):
    return spark.createDataFrame(
        [(None if v is None else D(v),) for v in values], "x decimal(22,2)"
    )


def brute_force(values, p):
    ordered = sorted(D(v) for v in values if v is not None)
    place = D(str(p)) * (len(ordered) - 1)
    low = int(place)
    high = min(low + 1, len(ordered) - 1)
    return float(ordered[low] + (place - low) * (ordered[high] - ordered[low]))


PROBABILITIES = (0, 0.25, 0.5, 0.75, 0.9, 1)


@pytest.mark.parametrize("buckets", [3, 4096])
@pytest.mark.parametrize(
    "values",
    [
        ["5.00"],
        ["1.00", "2.00"],
        ["7.77"] * 40 + ["-3.10", None],
        [str(D(random.Random(1).randint(-(10**9), 10**12)) / 100)] * 3 + ["0.01", "0.02", None],
        [str(D(random.Random(i).randint(-5000, 10**7)) / 100) for i in range(300)],
    ],
    ids=["one", "two", "hot value", "wide", "random"],
)
def test_quantiles_against_sorting(spark, monkeypatch, values, buckets):
    monkeypatch.setattr(quantiles_module, "BUCKETS", buckets)
    got = exact_quantiles(amounts(spark, values), "x", PROBABILITIES)
    assert got == pytest.approx([brute_force(values, p) for p in PROBABILITIES], abs=1e-9)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(amounts(spark, [None]), "x", (0.5,)) == [None]


CUSTOMERS = [(1, "a"), (2, "b"), (3, "c")]
ORDERS = [
    (10, 1, date(1998, 9, 1), "10.00"),
    (11, 1, date(1998, 8, 1), "20.00"),
    (12, 2, date(1998, 9, 2), "5.55"),
]


def frames(spark):
    customers = spark.createDataFrame(CUSTOMERS, "c_custkey bigint, c_name string")
    orders = spark.createDataFrame(
        [(k, c, d, D(p)) for k, c, d, p in ORDERS],
        "o_orderkey bigint, o_custkey bigint, o_orderdate date, o_totalprice decimal(12,2)",
    )
    return customers, orders


def test_rfm(spark, store):
    rfm = analytics.customer_rfm(*frames(spark), as_of=date(1998, 9, 2))
    assert rows(rfm) == [
        (1, "a", date(1998, 9, 1), 2, D("30.00"), 1),
        (2, "b", date(1998, 9, 2), 1, D("5.55"), 0),
        (3, "c", None, 0, None, None),
    ]
    assert [r.c_custkey for r in analytics.rfm_sample(rfm, 1).collect()] == [1]
    today = analytics.customer_rfm(*frames(spark))
    assert today.filter("recency_days <> datediff(current_date(), last_order_date)").isEmpty()


def test_rfm_is_stored(spark, store):
    from tidewater.schemas import CUSTOMER_RFM_SCORES, CUSTOMER_SILVER, ORDERS_SILVER

    customers, orders = frames(spark)
    store.overwrite(CUSTOMER_SILVER, customers)
    store.overwrite(ORDERS_SILVER, orders)
    for _ in range(2):
        analytics.load_customer_rfm(store, date(1998, 9, 2))
    assert rows(store.read(CUSTOMER_RFM_SCORES), "c_custkey", "frequency") == [(1, 2), (2, 1), (3, 0)]


def test_monthly_sales(spark):
    got = [tuple(r) for r in analytics.monthly_sales(frames(spark)[1]).collect()]
    assert got == [
        (date(1998, 8, 1), 1, D("20.00"), D("20.000000")),
        (date(1998, 9, 1), 2, D("15.55"), D("7.775000")),
    ]


def test_quartiles_and_distributions(spark):
    assert tuple(analytics.spend_quartiles(frames(spark)[1]).first()) == pytest.approx(
        (11.6625, 17.775, 23.8875)
    )
    ltv = spark.createDataFrame(
        [(1, "VIP", True, 2), (2, "GOLD", True, 1), (3, "VIP", False, 0)],
        "c_custkey int, customer_tier string, is_active boolean, total_orders int",
    )
    assert rows(analytics.tier_distribution(ltv)) == [("GOLD", 1), ("VIP", 2)]
    assert rows(analytics.activity_flags(ltv)) == [(False,), (True,)]
    assert rows(analytics.customers_with_orders(ltv), "c_custkey") == [(1,), (2,)]
    assert rows(analytics.customers_with_orders(ltv, 1), "c_custkey") == [(1,)]
