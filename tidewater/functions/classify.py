"""Business classifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower spend bound and tier, highest first.
REVENUE_TIERS = (
    (500000, "VIP"),
    (100000, "GOLD"),
    (10000, "SILVER"),
)
REVENUE_DEFAULT = "STANDARD"

# Status code and description.
STATUS_DESCRIPTIONS = (
    ("F", "FINISHED"),
    ("O", "OPEN"),
    ("P", "PENDING"),
)
STATUS_DEFAULT = "UNKNOWN"

# Priority text prefix and rank.
PRIORITY_RANKS = (
    ("1-URGENT", 1),
    ("2-HIGH", 2),
    ("3-MEDIUM", 3),
    ("4-NOT SPECIFIED", 4),
    ("5-LOW", 5),
)
PRIORITY_DEFAULT = 9


def _first_match(branches: list[tuple[Column, Column]], default: Column) -> Column:
    (condition, value), *rest = branches
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def classify_customer_revenue(total: Column) -> Column:
    """Spend tier; a customer without spend (NULL) is in the default tier."""
    total = total.cast("double")
    return _first_match(
        [(total >= F.lit(float(bound)), F.lit(tier)) for bound, tier in REVENUE_TIERS],
        F.lit(REVENUE_DEFAULT),
    )


def classify_orderstatus(status: Column) -> Column:
    return _first_match(
        [(status == F.lit(code), F.lit(text)) for code, text in STATUS_DESCRIPTIONS],
        F.lit(STATUS_DEFAULT),
    )


def classify_priority_rank(priority: Column) -> Column:
    return _first_match(
        [(priority.startswith(prefix), F.lit(rank)) for prefix, rank in PRIORITY_RANKS],
        F.lit(PRIORITY_DEFAULT),
    )
