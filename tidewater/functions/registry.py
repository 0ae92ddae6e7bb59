"""Make the column functions callable by name from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .classify import (
    PRIORITY_DEFAULT,
    PRIORITY_RANKS,
    REVENUE_DEFAULT,
    REVENUE_TIERS,
    STATUS_DEFAULT,
    STATUS_DESCRIPTIONS,
)
from .validate import EMAIL_PATTERN, PHONE_PATTERN


def _case(branches: list[str], default: str) -> str:
    return f"CASE {' '.join(branches)} ELSE {default} END"


def sql_functions() -> dict[str, tuple[str, str, str]]:
    """Name -> (argument, return type, body), built from the same fixed values as the columns."""
    return {
        "classify_customer_revenue": (
            "total_spent DOUBLE",
            "STRING",
            _case(
                [f"WHEN total_spent >= {bound} THEN '{tier}'" for bound, tier in REVENUE_TIERS],
                f"'{REVENUE_DEFAULT}'",
            ),
        ),
        "classify_orderstatus": (
            "status STRING",
            "STRING",
            _case(
                [f"WHEN status = '{code}' THEN '{text}'" for code, text in STATUS_DESCRIPTIONS],
                f"'{STATUS_DEFAULT}'",
            ),
        ),
        "classify_priority_rank": (
            "priority STRING",
            "INT",
            _case(
                [
                    f"WHEN startswith(priority, '{prefix}') THEN {rank}"
                    for prefix, rank in PRIORITY_RANKS
                ],
                str(PRIORITY_DEFAULT),
            ),
        ),
        "validate_phone_number": (
            "phone STRING",
            "BOOLEAN",
            f"trim(phone) RLIKE r'{PHONE_PATTERN}'",
        ),
        "validate_email": ("email STRING", "BOOLEAN", f"trim(email) RLIKE r'{EMAIL_PATTERN}'"),
    }


def register_functions(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions. Their bodies are inlined, so plans stay in codegen."""
    functions = sql_functions()
    for name, (argument, returns, body) in functions.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument}) RETURNS {returns} RETURN {body}"
        )
    return list(functions)
