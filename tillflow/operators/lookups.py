"""Attributes of a fact's store or product."""

from __future__ import annotations

from pyspark.sql import DataFrame

def lookup(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Adds the columns of ``dimension``, which has one row per ``key``. Facts
    without a match keep nulls; none is lost.

    There is no hint: Spark broadcasts a dimension whose files are below its
    threshold and otherwise shuffles. Sizes then seen at run time decide between
    hashing and sorting, and split the partitions of keys with too many facts.
    """
    return facts.join(dimension, key, "left")
