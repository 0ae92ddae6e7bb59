"""Role-based column masks. The role is known when the plan is built, so no role test runs per row."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import right_chars

# Role names and what each one sees.
FULL_ROLES = frozenset({"ACCOUNTADMIN", "TPCH_ADMIN", "TPCH_DEVELOPER"})
PARTIAL_ROLES = frozenset({"TPCH_ANALYST"})
EMAIL_LOCAL_PART = r"(^[^@]{2})[^@]+"
EMAIL_HIDDEN = "***@masked.com"
PHONE_PREFIX = "XXX-XXX-"
PHONE_HIDDEN = "XXX-XXX-XXX"
SSN_HIDDEN = "***-**-****"


def mask_email(email: Column, role: str, strict: bool = False) -> Column:
    """Full, first two characters plus domain, or a constant.

    A local part of one or two characters is too short for the partial mask and stays readable to
    analysts; ``strict=True`` hides it as well.
    """
    if role in FULL_ROLES:
        return email
    if role in PARTIAL_ROLES:
        partial = F.regexp_replace(email, EMAIL_LOCAL_PART, "$1***")
        if strict:
            short = F.instr(email, "@").between(1, 3)
            return F.when(short, F.regexp_replace(email, r"^[^@]*", "***")).otherwise(partial)
        return partial
    return F.lit(EMAIL_HIDDEN)


def mask_phone(phone: Column, role: str) -> Column:
    """Full, last four digits, or a constant. Numeric columns are read as text."""
    text = phone.cast("string")
    if role in FULL_ROLES:
        return text
    if role in PARTIAL_ROLES:
        return F.concat(F.lit(PHONE_PREFIX), right_chars(text, 4))
    return F.lit(PHONE_HIDDEN)


def mask_ssn(ssn: Column, role: str) -> Column:
    return ssn if role in FULL_ROLES else F.lit(SSN_HIDDEN)


MASKS: Mapping[str, Callable[[Column, str], Column]] = {
    "email": mask_email,
    "phone_number": mask_phone,
    "ssn_last_9": mask_ssn,
}


def _listed(roles: frozenset[str]) -> str:
    return ", ".join(f"'{r}'" for r in sorted(roles))


def mask_sql(column: str, role: str) -> str:
    """The mask of a column as SQL text that tests ``role``, an expression, when a query is read."""
    full, partial = f"{role} IN ({_listed(FULL_ROLES)})", f"{role} IN ({_listed(PARTIAL_ROLES)})"
    text = f"CAST({column} AS STRING)"
    return {
        "email": f"CASE WHEN {full} THEN {column} WHEN {partial} THEN"
        f" regexp_replace({column}, '{EMAIL_LOCAL_PART}', '$1***') ELSE '{EMAIL_HIDDEN}' END",
        "phone_number": f"CASE WHEN {full} THEN {text} WHEN {partial} THEN"
        f" concat('{PHONE_PREFIX}', right({text}, 4)) ELSE '{PHONE_HIDDEN}' END",
        "ssn_last_9": f"CASE WHEN {full} THEN {column} ELSE '{SSN_HIDDEN}' END",
    }[column]


def masked(
    df: DataFrame, role: str, masks: Mapping[str, Callable[[Column, str], Column]] = MASKS
) -> DataFrame:
    """``df`` as ``role`` may see it. Only the given role counts, not roles it inherits from."""
    return df.select(
        *[masks[c](F.col(c), role).alias(c) if c in masks else F.col(c) for c in df.columns]
    )
