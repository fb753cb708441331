"""What a query reports of itself: every batch's progress as a table, and its state as rows."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tillflow.sources.files import read_if_exists

PROGRESS = ("query string, run string, batch_id long, at string, input_rows long, "
            "arriving_per_sec double, processed_per_sec double, millis long, state_rows long, late_rows long")


class ProgressTable(StreamingQueryListener):
    """Appends the progress of every batch of a session's queries to a table.

    A query itself remembers only its last hundred. ``wait`` returns when all that a query
    has reported is written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}
        spark.streams.addListener(self)

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows,
               float(p.inputRowsPerSecond), float(p.processedRowsPerSecond), p.durationMs.get("triggerExecution"),
               sum(s.numRowsTotal for s in p.stateOperators), sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
        self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, *queries: StreamingQuery, seconds: float = 60.0) -> None:
        for query in queries:
            if not self._end(str(query.runId)).wait(seconds):
                raise TimeoutError(f"no end of query {query.name} was reported in {seconds} s")

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return read_if_exists(spark, path, spark.createDataFrame([], PROGRESS).schema)[0]


def agreeing(progress: DataFrame, slack_millis: int = 50) -> DataFrame:
    """Batches with ``agrees``: are the rows the reported rate times the time that they took? The
    query reads its clock once for each, so they may be some milliseconds apart."""
    by_rate = F.when(F.col("processed_per_sec") > 0, F.col("input_rows") * 1000 / F.col("processed_per_sec"))
    apart = F.abs(by_rate - F.col("millis")) <= slack_millis
    return progress.withColumn("agrees", F.coalesce(apart, F.col("input_rows") == 0))


def state_rows(spark: SparkSession, checkpoint: str, values: tuple[str, ...], **options: str) -> DataFrame:
    """The entries of an aggregating query's state after its last batch: the groups' columns, and
    its buffers in their order, named by ``values`` (Spark's own names for them repeat)."""
    state = spark.read.format("statestore").options(**options).load(checkpoint)
    buffers = state.schema["value"].dataType.fields
    named = ",".join(f"{n}:{f.dataType.simpleString()}" for n, f in zip(values, buffers, strict=True))
    return state.select("key.*", F.col("value").cast(f"struct<{named}>").alias("value")).select(
        *state.schema["key"].dataType.fieldNames(), "value.*")
