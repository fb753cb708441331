"""Text columns for keys, labels and report figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number with leading zeros; longer numbers are kept whole."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit(prefix), padded)


def group_label(*parts: Column) -> Column:
    return F.concat_ws(" / ", *parts)


def iso_text(date: Column) -> Column:
    return date.cast("string")


def figure(value: Column, digits: int) -> Column:
    """A number as text with thousands separators and ``digits`` decimals."""
    return F.format_number(value, digits)
