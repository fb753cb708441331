"""Word patterns and column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What separates words: the blank, tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order; none for an empty one."""
    return F.array_remove(F.split(text, SPACE), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")
