"""Contiguous surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.session import stored


def surrogate_key(
    df: DataFrame, *order_by: str, name: str = "transaction_id", start: int = 1,
    copies: bool = False,
) -> DataFrame:
    """Numbers the rows ``start``, ``start + 1``, .. in the order of some columns.

    The rows are range-partitioned and sorted, numbered inside their partition,
    and shifted by the size of the partitions before. Only one row per partition
    meets in a single window. The sorted rows are written once, because counting
    and numbering must see the same partition bounds.

    Rows that are equal in the sort columns share a partition. Where they may be
    many, set ``copies``: they are then told apart, and spread, by their place in
    the files, so ``df`` has to be a scan (with filters and columns at will).
    """
    placed = stored(_placed(df, order_by, copies), "numbered")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    # One row per partition of the sort: bounded by the shuffle, not by the data.
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + F.col("_pos") + start).alias(name), *df.columns
    )


def _placed(df: DataFrame, order_by: tuple[str, ...], copies: bool) -> DataFrame:
    """The rows with the partition they were sorted into and their place in it."""
    order = list(order_by)
    if copies:
        df = df.withColumn("_place", F.monotonically_increasing_id())
        order.append("_place")
    part, row_id = F.spark_partition_id(), F.monotonically_increasing_id()
    return df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", part.alias("_part"), (row_id - F.shiftleft(part.cast("long"), 33)).alias("_pos")
    )
