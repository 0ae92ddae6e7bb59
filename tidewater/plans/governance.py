"""Sensitive data, curated views and what may leave the platform."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import uniform_int, validate_email, validate_phone_number, zero_padded
from ..operators.masking import masked
from ..operators.store import TableStore
from ..schemas import CUSTOMER_SENSITIVE, CUSTOMER_SILVER

_MODULUS = 1_000_000_000


def customer_sensitive(customers: DataFrame, phone: Column | None = None) -> DataFrame:
    """Customers with made-up e-mail, nine-digit number and phone number.

    The phone number depends only on the key (see ``uniform_int``), so a rebuild or a retried task
    gives the same numbers. The key is reduced before the product, which keeps it within 64 bits.
    """
    key = F.col("c_custkey")
    number = F.abs((key % _MODULUS * 123456789) % _MODULUS)
    return customers.select(
        "c_custkey",
        "c_name",
        "c_address",
        "c_phone",
        "c_acctbal",
        "c_nation_name",
        "c_region_name",
        "c_mktsegment",
        F.concat(F.lit("customer_"), key.cast("string"), F.lit("@company.com")).alias("email"),
        zero_padded(number, 9).alias("ssn_last_9"),
        (uniform_int(100000000, 999999999, key) if phone is None else phone).alias("phone_number"),
    )


def build_customer_sensitive(store: TableStore) -> None:
    store.overwrite(CUSTOMER_SENSITIVE, customer_sensitive(store.read(CUSTOMER_SILVER)))


def read_sensitive(store: TableStore, role: str) -> DataFrame:
    """The sensitive table as a role sees it: the accessor to hand out."""
    return masked(store.read(CUSTOMER_SENSITIVE), role)


def validate_contacts(sensitive: DataFrame, role: str, rows: int | None = None) -> DataFrame:
    """Contact checks on the text the role sees; with ``rows``, for the first customers in key order."""
    checked = (
        masked(sensitive, role)
        .select(
            "c_custkey",
            "c_name",
            validate_phone_number(F.col("phone_number")).alias("is_valid_pn"),
            validate_email(F.col("email")).alias("is_valid_email"),
        )
    )
    return checked if rows is None else checked.orderBy("c_custkey").limit(rows)


def customer_public(sensitive: DataFrame) -> DataFrame:
    return sensitive.select(
        "c_custkey", "c_name", "c_nation_name", "c_region_name", "c_mktsegment"
    )


def customer_summary(sensitive: DataFrame) -> DataFrame:
    return sensitive.groupBy("c_nation_name", "c_region_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("total_customers")
    )


CURATED = {
    "vw_customer_public": customer_public,
    "vw_customer_summary": customer_summary,
}


def create_views(store: TableStore) -> list[str]:
    """Register the curated views by name."""
    sensitive = store.read(CUSTOMER_SENSITIVE)
    for name, build in CURATED.items():
        build(sensitive).createOrReplaceTempView(name)
    return list(CURATED)


def publish(
    spark: SparkSession, sensitive: DataFrame, out_dir: str, views: Sequence[str] = tuple(CURATED)
) -> dict[str, str]:
    """Export curated views for outside consumers; any other name is refused."""
    refused = [v for v in views if v not in CURATED]
    if refused:
        raise PermissionError(f"not cleared for sharing: {', '.join(refused)}")
    paths = {view: f"{out_dir.rstrip('/')}/{view}" for view in views}
    for view, path in paths.items():
        CURATED[view](sensitive).write.mode("overwrite").parquet(path)
    return paths
