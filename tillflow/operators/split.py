"""Holding out the most recent rows of a series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TEST_DAYS = 180  # fixed value: rows held out


def indexed(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``idx``, the place in date order, counted from 0."""
    return df.withColumn("idx", F.row_number().over(W.partitionBy(*keys).orderBy("date")) - 1)


def holdout(df: DataFrame, n: int = TEST_DAYS, keys: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``idx`` and ``part``: the last ``n`` rows are "test", the rest "train"."""
    rows = F.count("*").over(W.partitionBy(*keys))
    part = F.when(F.col("idx") < rows - n, "train").otherwise("test")
    return indexed(df, keys).withColumn("part", part)


def train_part(split: DataFrame) -> DataFrame:
    return split.where("part = 'train'").drop("idx", "part")


def test_part(split: DataFrame) -> DataFrame:
    return split.where("part = 'test'").drop("idx", "part")
