"""Scalar building blocks: keys, masks, display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the mask looks for and what it leaves.
EMAIL_PATTERN = r"(^[^@]{1,3})[^@]*@[^.]+\.(.+)"
EMAIL_MASK = "$1***@***.***"


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number with leading zeros; longer numbers are kept whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def mask_email(email: Column) -> Column:
    """Keep up to three leading characters; text that is not an address stays as it is."""
    return F.regexp_replace(email, EMAIL_PATTERN, EMAIL_MASK)


def mask_name(name: Column) -> Column:
    """First letter only."""
    return F.concat(F.left(name, F.lit(1)), F.lit("***"))


def shortened(text: Column, limit: int) -> Column:
    """Text cut to ``limit`` characters, with three dots where something was cut."""
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("..."))).otherwise(text)


def as_count(number: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(number, 0)


def as_dollars(amount: Column, digits: int) -> Column:
    """Currency text with thousands separators."""
    return F.concat(F.lit("$"), F.format_number(amount, digits))
