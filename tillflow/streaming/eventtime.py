"""Streams in event time: replays dropped, days that close, rows that come too late.

State is bounded by the delay that a query allows: what the watermark has passed is given up.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators.totals import daily_rollup
from tillflow.schema import COORDINATED
from tillflow.sources.files import read_if_exists
from tillflow.streaming import live
from tillflow.streaming.files import exists, moved

EVENT_TIME = "event_time"


def coordinated_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Messages kept as files with all columns of a topic: where each stands, and its time."""
    return spark.readStream.schema(COORDINATED).options(**options).parquet(path)


def deduped(messages: DataFrame, delay: str, keys: tuple[str, ...] = live.COORDINATES) -> DataFrame:
    """Messages by their coordinates once each. A replay is known as one for ``delay`` after the
    time of its message, and the state holds the coordinates of that long."""
    return messages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(keys))


def dated_rows(transactions: DataFrame) -> DataFrame:
    """Transactions with the start of their day as event time."""
    return transactions.withColumn(EVENT_TIME, F.col("date").cast("timestamp"))


def closing_days(transactions: DataFrame, delay: str) -> DataFrame:
    """The daily roll-up of a stream: a day is given out once, when the watermark has passed its
    end. The state holds the days that are still open."""
    rows = dated_rows(transactions).withWatermark(EVENT_TIME, delay)
    days = daily_rollup(rows.withColumn("day", F.window(EVENT_TIME, "1 day")), ("day",))
    return days.drop("day")


def start_days(
    transactions: DataFrame, sink: live.BatchSink, checkpoint: str, delay: str, name: str = "closing_days", **trigger,
) -> StreamingQuery:
    """Appends every day as it closes."""
    return live._started(
        closing_days(transactions, delay), "append", sink, "closed_at", name, checkpoint,
        trigger or {"availableNow": True}, 0)


# --- late rows ---------------------------------------------------------------

def _closed(watermark: Column) -> Column:
    """Has the day of a row closed, as the windowed query would say?"""
    return F.coalesce(F.col(EVENT_TIME) + F.expr("interval 1 day") <= watermark, F.lit(False))


def routed_files(path: str, delay: str) -> live.BatchSink:
    """Tells rows that come in time from late ones and those without a date, each batch in one
    write, and keeps the latest event time after each batch.

    A row is late if its day had closed by the rows of the batches before. The query of
    `closing_days` over the rows in time, with the same delay, drops none of them: it never knows
    of a later event than this one did. A batch is moved to its place when it is whole, and one
    that is there is not written again: who reads the folder as a stream sees each row once.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = f"{path}/rows/{live.BATCH}={batch_id}"
        high = _high(spark, path, batch_id)
        if not exists(spark, place):
            rows = dated_rows(batch)
            watermark = F.lit(high).cast("timestamp") - F.expr(f"interval {delay}")
            side = F.when(F.col("date").isNull(), "undated").when(_closed(watermark), "late").otherwise("in_time")
            draft = f"{path}/drafts/{uuid.uuid4().hex}"
            rows.withColumn("side", side).write.partitionBy("side").parquet(draft)
            moved(spark, draft, place)
        written = read_if_exists(spark, place, dated_rows(batch).schema)[0]
        mark = written.agg(F.greatest(F.max(EVENT_TIME), F.lit(high).cast("timestamp")).alias("high"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/{live.BATCH}={batch_id}")

    return sink


def _high(spark: SparkSession, path: str, batch_id: int):
    """The latest event time of the batches before this one."""
    marks, _ = read_if_exists(spark, f"{path}/marks", "high timestamp, batch_id long")
    return marks.where(F.col(live.BATCH) < batch_id).agg(F.max("high")).first()[0]


def start_routing(
    transactions: DataFrame, path: str, checkpoint: str, delay: str, name: str = "routing", **trigger,
) -> StreamingQuery:
    return live._started(
        transactions, "append", routed_files(path, delay), "received_at", name, checkpoint,
        trigger or {"availableNow": True}, 0)


def rows_of(spark: SparkSession, path: str, side: str, schema: T.StructType) -> DataFrame:
    """The rows that went to one side: ``in_time``, ``late`` or ``undated``."""
    places = [T.StructField("batch_id", T.LongType()), T.StructField("side", T.StringType())]
    rows, _ = read_if_exists(spark, f"{path}/rows", T.StructType(schema.fields + places))
    return rows.where(F.col("side") == side).drop("side")


def in_time_stream(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """The rows in time as a stream, batch by batch."""
    return spark.readStream.schema(schema).options(**options).parquet(f"{path}/rows/*/side=in_time")
