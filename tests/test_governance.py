from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewater.operators import mask_email, mask_phone, mask_ssn, masked
from tidewater.plans import governance
from tidewater.schemas import CUSTOMER_SENSITIVE, CUSTOMER_SILVER

FULL = ["ACCOUNTADMIN", "TPCH_ADMIN", "TPCH_DEVELOPER"]
HIDDEN = ["TPCH_VIEWER", "SOMEONE", "tpch_admin"]


def contacts(spark):
    return spark.createDataFrame(
        [
            (1, "customer_1@company.com", 123456789, "000000001"),
            (2, "ab@x.y", 5, "1"),
            (3, "a@x.y", None, None),
            (4, None, 987654321, "2"),
        ],
        "k int, email string, phone_number bigint, ssn_last_9 string",
    )


@pytest.mark.parametrize("role", FULL)
def test_full_roles_see_everything(spark, role):
    assert rows(masked(contacts(spark), role)) == [
        (1, "customer_1@company.com", "123456789", "000000001"),
        (2, "ab@x.y", "5", "1"),
        (3, "a@x.y", None, None),
        (4, None, "987654321", "2"),
    ]


def test_analyst_sees_parts(spark):
    assert rows(masked(contacts(spark), "TPCH_ANALYST")) == [
        (1, "cu***@company.com", "XXX-XXX-6789", "***-**-****"),
        (2, "ab@x.y", "XXX-XXX-5", "***-**-****"),
        (3, "a@x.y", None, "***-**-****"),
        (4, None, "XXX-XXX-4321", "***-**-****"),
    ]


@pytest.mark.parametrize("role", HIDDEN)
def test_others_see_constants_even_for_null(spark, role):
    got = rows(masked(contacts(spark), role))
    assert {r[1:] for r in got} == {("***@masked.com", "XXX-XXX-XXX", "***-**-****")}


def test_strict_mask_hides_short_names(spark):
    strict = contacts(spark).select(mask_email(F.col("email"), "TPCH_ANALYST", strict=True))
    assert [r[0] for r in strict.collect()] == ["cu***@company.com", "***@x.y", "***@x.y", None]


def test_single_masks(spark):
    row = spark.range(1).select(
        mask_phone(F.lit("0123456789"), "TPCH_ANALYST"), mask_ssn(F.lit("1"), "TPCH_ANALYST")
    )
    assert tuple(row.first()) == ("XXX-XXX-6789", "***-**-****")


def customers(spark):
    return spark.createDataFrame(
        [(1, "N", "M"), (9, "N", "M"), (10**17 + 3, "N", "B"), (-7, "Z", "M")],
        "c_custkey bigint, c_nation_name string, c_mktsegment string",
    ).selectExpr(
        "c_custkey", "concat('c', c_custkey) c_name", "'a' c_address", "'p' c_phone",
        "cast(1 as decimal(12,2)) c_acctbal", "c_nation_name", "'R' c_region_name", "c_mktsegment",
    )


def test_sensitive_columns(spark):
    got = {r.c_custkey: r for r in governance.customer_sensitive(customers(spark)).collect()}
    for key, row in got.items():
        assert row.email == f"customer_{key}@company.com"
        remainder = abs(key) * 123456789 % 1000000000
        assert row.ssn_last_9 == f"{remainder:09d}"
        assert 100000000 <= row.phone_number <= 999999999
    again = governance.customer_sensitive(customers(spark).repartition(3))
    assert {r.c_custkey: r.phone_number for r in again.collect()} == {
        k: r.phone_number for k, r in got.items()
    }


def test_views_publishing_and_masked_access(spark, store, tmp_path):
    silver = customers(spark)
    store.overwrite(CUSTOMER_SILVER, silver)
    governance.build_customer_sensitive(store)
    assert governance.create_views(store) == ["vw_customer_public", "vw_customer_summary"]
    assert spark.table("vw_customer_public").columns == [
        "c_custkey", "c_name", "c_nation_name", "c_region_name", "c_mktsegment",
    ]
    summary = rows(spark.table("vw_customer_summary"), "c_nation_name", "c_mktsegment", "total_customers")
    assert summary == [("N", "B", 1), ("N", "M", 2), ("Z", "M", 1)]
    viewer = governance.read_sensitive(store, "TPCH_VIEWER")
    assert {r.email for r in viewer.collect()} == {"***@masked.com"}
    checked = governance.validate_contacts(
        governance.customer_sensitive(silver), "TPCH_DEVELOPER", rows=2
    )
    assert rows(checked, "c_custkey", "is_valid_pn", "is_valid_email") == [
        (-7, False, True), (1, False, True),
    ]
    out = str(tmp_path / "out")
    sensitive = governance.customer_sensitive(silver)
    assert set(governance.publish(spark, sensitive, out)) == set(governance.CURATED)
    assert "email" not in spark.read.parquet(f"{out}/vw_customer_public").columns
    with pytest.raises(PermissionError):
        governance.publish(spark, sensitive, out, ["customer_sensitive"])


def test_masked_by_name_follows_the_role(spark, store):
    from tidewater.operators.masking import masked
    from tidewater.sources.catalog import register_masked, use_role

    people = spark.createDataFrame(
        [(1, "customer_1@company.com", "012345678", 123456789), (2, "a@b.c", None, None), (3, None, "1", 12)],
        "c_custkey long, email string, ssn_last_9 string, phone_number long",
    )
    store.overwrite(CUSTOMER_SENSITIVE, people)
    text = f"SELECT * FROM {register_masked(store)}"
    plain = store.read(CUSTOMER_SENSITIVE)
    for role in ("", "TPCH_VIEWER", "TPCH_ANALYST", "TPCH_ADMIN", "TPCH_DEVELOPER", "x' OR 'a' = 'a"):
        if role:
            use_role(spark, role)
        assert rows(spark.sql(text)) == rows(masked(plain, role)), role
    register_masked(store)  # a new registration hides everything again
    assert rows(spark.sql(text)) == rows(masked(plain, ""))
