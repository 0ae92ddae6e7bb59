"""Reusable column functions. All stay inside built-in expressions; there are no Python UDFs."""

from .classify import classify_customer_revenue, classify_orderstatus, classify_priority_rank
from .registry import register_functions
from .scalars import clamp_negative, clerk_id, right_chars, uniform_int, zero_padded
from .validate import validate_email, validate_phone_number

__all__ = [
    "classify_customer_revenue",
    "classify_orderstatus",
    "classify_priority_rank",
    "validate_phone_number",
    "validate_email",
    "register_functions",
    "clamp_negative",
    "clerk_id",
    "right_chars",
    "uniform_int",
    "zero_padded",
]
