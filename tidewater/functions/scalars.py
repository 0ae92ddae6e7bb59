"""Small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clerk_id(clerk: Column) -> Column:
    """First run of digits in the clerk text as a number; NULL if there is none.

    More than nine digits are an error, not NULL; more than 38 are NULL.
    """
    return F.regexp_substr(clerk, F.lit("[0-9]+")).try_cast("decimal(38,0)").cast("decimal(9,0)")


def clamp_negative(value: Column) -> Column:
    """Negative becomes zero. ``greatest`` would turn NULL into zero, so it is not used."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def right_chars(text: Column, count: int) -> Column:
    return F.right(text, F.lit(count))


def zero_padded(number: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is cut to ``width``, as LPAD does."""
    return F.lpad(number.cast("string"), width, "0")


def uniform_int(low: int, high: int, *keys: Column, seed: int = 0) -> Column:
    """Pseudo-random integer in ``[low, high]`` that depends only on the keys and the seed.

    A retried task gives the same value again, which a random generator would not. The top 60
    bits of an MD5 digest are used, so other engines can reproduce it.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[key.cast("string") for key in keys])
    bits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return F.lit(low).cast("bigint") + bits % F.lit(high - low + 1)
