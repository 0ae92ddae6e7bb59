"""Contact checks: the whole trimmed text must match; NULL stays NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. ``\z`` (not ``$``) so that a trailing newline does not pass.
PHONE_PATTERN = r"^[0-9]{10,15}\z"
EMAIL_PATTERN = r"^\S+@\S+\.\S+\z"


def validate_phone_number(phone: Column) -> Column:
    return F.trim(phone.cast("string")).rlike(PHONE_PATTERN)


def validate_email(email: Column) -> Column:
    return F.trim(email).rlike(EMAIL_PATTERN)
