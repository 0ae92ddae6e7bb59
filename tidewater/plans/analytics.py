"""Customer analytics and trends."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantiles
from ..operators.store import TableStore
from ..schemas import CUSTOMER_RFM_SCORES, CUSTOMER_SILVER, ORDERS_SILVER


def customer_rfm(customers: DataFrame, orders: DataFrame, as_of: date | None = None) -> DataFrame:
    """Last order, number of orders, spend and days since the last order per customer.

    ``as_of`` defaults to the current date. Orders are summed before the join.
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    totals = orders.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last_order_date"),
        F.count("o_orderkey").alias("frequency"),
        F.sum("o_totalprice").alias("monetary"),
    )
    return (
        customers.select("c_custkey", "c_name")
        .join(totals, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            "c_custkey",
            "c_name",
            "last_order_date",
            F.coalesce("frequency", F.lit(0)).cast("bigint").alias("frequency"),
            "monetary",
            F.datediff(today, F.col("last_order_date")).alias("recency_days"),
        )
    )


def load_customer_rfm(store: TableStore, as_of: date | None = None) -> None:
    """Replace the stored scores."""
    store.overwrite(
        CUSTOMER_RFM_SCORES,
        customer_rfm(store.read(CUSTOMER_SILVER), store.read(ORDERS_SILVER), as_of),
    )


def rfm_sample(rfm: DataFrame, rows: int = 10) -> DataFrame:
    """A few customers that have ordered, in key order."""
    return rfm.filter(F.col("frequency") > 0).orderBy("c_custkey").limit(rows)


def monthly_sales(orders: DataFrame) -> DataFrame:
    """Orders, revenue and average order value per month, oldest first.

    The result has one row per month, so ``toPandas()`` on it is safe.
    """
    return (
        orders.withColumn("month", F.trunc("o_orderdate", "month"))
        .groupBy("month")
        .agg(
            F.count("o_orderkey").alias("order_count"),
            F.sum("o_totalprice").alias("total_revenue"),
            F.avg("o_totalprice").alias("avg_order_value"),
        )
        .sort("month")
    )


def spend_quartiles(orders: DataFrame) -> DataFrame:
    """Exact quartiles of spend per customer, interpolated, as one row (p1, p2, p3)."""
    spend = orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total_spend"))
    values = exact_quantiles(spend, "total_spend", (0.25, 0.5, 0.75))
    return orders.sparkSession.createDataFrame(
        [tuple(values)], "p1 double, p2 double, p3 double"
    )


def tier_distribution(ltv: DataFrame) -> DataFrame:
    return ltv.groupBy("customer_tier").agg(F.count(F.lit(1)).alias("customers"))


def activity_flags(ltv: DataFrame) -> DataFrame:
    return ltv.select("is_active").distinct()


def customers_with_orders(ltv: DataFrame, rows: int | None = None) -> DataFrame:
    """Customers that have ordered; ``rows`` takes the first ones in key order."""
    found = ltv.filter(F.col("total_orders") > 0)
    return found if rows is None else found.orderBy("c_custkey").limit(rows)
