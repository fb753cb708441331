"""Running totals and raw rows from a stream of transaction messages.

Every query needs a checkpoint folder: a restart goes on where the last run
stopped. Both targets take a repeated batch without doubling it, so a batch that
failed half way may simply run again.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillflow.functions.codec import dead_letters, decode
from tillflow.operators.totals import group_totals
from tillflow.schema import LIVE_RAW, LIVE_TOTALS, MESSAGE
from tillflow.sinks.files import preview
from tillflow.sources.files import read_if_exists
from tillflow.sources.jdbc import Database
from tillflow.streaming.files import listed

BATCH = "batch_id"
RUN = "run"
STATE_PARTITIONS = 8
BATCH_BYTES = 1024**4
BATCH_MESSAGES = 1_000_000_000

#: Columns that name a message of a topic.
COORDINATES = ("topic", "partition", "offset")

#: What a batch is handed to: the rows and the number of the batch.
BatchSink = Callable[[DataFrame, int], None]


#: State on the executors' disks, with a bound on its memory in each executor, whatever it holds.
STATE_ON_DISK = {
    "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "rocksdb.boundedMemoryUsage": "true",
    "rocksdb.maxMemoryUsageMB": "500",
    "rocksdb.trackTotalNumberOfRows": "false",  # a look-up for every entry written
}


def live_session(
    spark: SparkSession, partitions: int = STATE_PARTITIONS, large_state: bool = False
) -> SparkSession:
    """A session for live queries beside that of the batch jobs.

    State has as many partitions as the session's shuffles, fixed with the first
    batch of a checkpoint. Batch jobs over many facts want many; totals of a few
    groups, summed before the shuffle, want few. With ``large_state``, an entry for every
    message, it lies on disk; by default it is held in the heap of the executors, twice, with
    some 400 bytes an entry.
    """
    session = spark.newSession()
    zone = "spark.sql.session.timeZone"
    session.conf.set(zone, spark.conf.get(zone))
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    for name, value in STATE_ON_DISK.items() if large_state else ():
        session.conf.set(f"spark.sql.streaming.stateStore.{name}", value)
    return session


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
    batch_messages: int = BATCH_MESSAGES, **options: str,
) -> DataFrame:
    """Messages of a topic, at most ``batch_messages`` in a batch: the first batch
    of a new query would else hold all that the topic has kept."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", batch_messages)
        .options(**options)
        .load()
    )


def file_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Messages kept as files with the columns of a topic: a table replayed as a
    stream. ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bounds a batch; by
    default a batch is large enough to keep a cluster busy and small enough to be
    repeated when it fails."""
    if not {"maxFilesPerTrigger", "maxBytesPerTrigger"} & options.keys():
        options = {**options, "maxBytesPerTrigger": str(BATCH_BYTES)}
    return spark.readStream.schema(MESSAGE).options(**options).parquet(path)


def running_totals(transactions: DataFrame) -> DataFrame:
    """Revenue and units per region and category so far, greatest revenue first.
    The state holds one entry per group; the messages of a batch are summed
    before they are shuffled to it."""
    return group_totals(transactions, "region", "category").orderBy(F.desc("total_revenue"))


# --- targets -----------------------------------------------------------------

def raw_files(path: str, run: str = "0") -> BatchSink:
    """Appends a batch under its run and number; running it again replaces it. Numbers
    start anew with a checkpoint: give each checkpoint a ``run`` of its own, else its
    batches replace those of the one before."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{RUN}={run}/{BATCH}={batch_id}")
    return sink


def totals_files(path: str, keep_hours: float = 24.0) -> BatchSink:
    """Replaces the totals. Every state is a folder of its own, numbered on from those
    there, and counts once its write has succeeded: readers see the last complete one, also
    after a new checkpoint. A state is deleted ``keep_hours`` after it was replaced, which
    is how long a reader may hold it. One query writes to a path."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = _states(spark, path)
        number = states[-1][0] + 1 if states else 0
        numbered = batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
        numbered.coalesce(1).write.mode("overwrite").parquet(_state(path, number))
        replaced_before = time.time() - keep_hours * 3600
        for (old, _), (_, replaced) in zip(states, states[1:]):
            if replaced < replaced_before:
                folder = spark._jvm.org.apache.hadoop.fs.Path(_state(path, old))
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return sink


def _state(path: str, number: int) -> str:
    return f"{path}/state-{number:012d}"


def _states(spark: SparkSession, path: str) -> list[tuple[int, float]]:
    """Number and time of every complete state, in order."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/state-*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done) or []
    return sorted(
        (int(f.getPath().getParent().getName().removeprefix("state-")), f.getModificationTime() / 1000)
        for f in found)


def raw_database(
    database: Database, table: str, keys: tuple[str, ...] = COORDINATES, **options: str
) -> BatchSink:
    """Appends a batch with its number. ``keys`` name a message and have to be
    carried by the query: rows an earlier attempt has written are left out.
    ``options`` are those of the write, such as column types."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
        if database.has_table(batch.sparkSession, table):
            written = database.read_table(batch.sparkSession, table)
            rows = missing_rows(rows, written.where(F.col(BATCH) == batch_id), keys)
        database.append(rows, table, **options)
    return sink


def totals_database(database: Database, table: str, **options: str) -> BatchSink:
    """Replaces the totals in a table that stays."""
    return lambda batch, batch_id: database.replace(batch, table, **options)


def missing_rows(batch: DataFrame, written: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of ``batch`` that are not among those already ``written``."""
    return batch.join(written.select(*keys), list(keys), "left_anti")


# --- queries -----------------------------------------------------------------

def _started(
    df: DataFrame, mode: str, sink: BatchSink, stamp: str, name: str, checkpoint: str,
    trigger: dict, show: int,
) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn(stamp, F.current_timestamp())
        if mode == "complete":
            # A few rows out of the state, computed once for the test and the
            # write. A batch of raw rows is not tested: that would read it twice.
            batch = batch.persist()
        try:
            if mode != "complete" or not batch.isEmpty():
                if show:
                    preview(batch, show)
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return (
        df.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_raw(
    messages: DataFrame, sink: BatchSink, checkpoint: str, name: str = "raw_records",
    permissive: bool = False, carry: tuple[str, ...] = (), show: int = 0, **trigger,
) -> StreamingQuery:
    """Appends every transaction with its time of arrival. ``trigger`` is that of
    ``DataStreamWriter.trigger``; by default all there is now, then stop."""
    return _started(
        decode(messages, permissive, carry), "append", sink, "received_at", name, checkpoint,
        trigger or {"availableNow": True}, show,
    )


def start_totals(
    messages: DataFrame, sink: BatchSink, checkpoint: str, name: str = "running_totals",
    permissive: bool = False, show: int = 0, **trigger,
) -> StreamingQuery:
    """Keeps the totals table at the state after the last batch."""
    return _started(
        running_totals(decode(messages, permissive)), "complete", sink, "updated_at", name,
        checkpoint, trigger or {"availableNow": True}, show,
    )


def start_rejects(
    messages: DataFrame, sink: BatchSink, checkpoint: str, name: str = "rejects", **trigger,
) -> StreamingQuery:
    """Appends every message that the other queries leave out, as it came, with its time of
    arrival: no message goes without a trace."""
    return _started(
        dead_letters(messages), "append", sink, "received_at", name, checkpoint,
        trigger or {"availableNow": True}, 0,
    )


def run_together(*queries: StreamingQuery, poll_seconds: float = 1.0) -> None:
    """Waits until any of the given queries ends, then stops the others. Only these are
    looked at: other queries of the session, ended or not, do not matter. The error of the
    query that failed is raised."""
    try:
        while not any(query.awaitTermination(poll_seconds) for query in queries):
            pass
    finally:
        for query in queries:
            query.stop()


def run_to_end(*queries: StreamingQuery) -> None:
    """Waits for queries that end by themselves (``availableNow``)."""
    for query in queries:
        query.awaitTermination()


# --- what the targets hold ---------------------------------------------------

def read_raw(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """All raw rows and whether there is a table yet."""
    rows, found = read_if_exists(spark, path, LIVE_RAW)
    return rows.drop(RUN), found


def read_totals(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """The totals of the last batch and whether there is a table yet."""
    states = _states(spark, path)
    if not states:
        return spark.createDataFrame([], LIVE_TOTALS), False
    return spark.read.schema(LIVE_TOTALS).parquet(_state(path, states[-1][0])), True


def read_shared(
    spark: SparkSession, totals_path: str, raw_path: str, run: str = "0"
) -> tuple[DataFrame, DataFrame, int | None]:
    """Totals and raw rows after the last batch that both targets hold, and its number; empty
    tables and None if they share none. Totals states are looked through from the last one, as
    many as the totals are ahead; raw rows of later batches are left out. Both queries have
    begun together, and cut their batches alike."""
    done = listed(spark, f"{raw_path}/{RUN}={run}/{BATCH}=*/_SUCCESS")
    last = max((int(p.split(f"{BATCH}=")[-1].split("/")[0]) for p in done), default=-1)
    layout = T.StructType([*LIVE_RAW.fields, T.StructField(RUN, T.StringType())])
    raw = read_if_exists(spark, raw_path, layout)[0].where(F.col(RUN) == run).drop(RUN)
    for number, _ in reversed(_states(spark, totals_path)):
        totals = spark.read.schema(LIVE_TOTALS).parquet(_state(totals_path, number))
        batch = totals.agg(F.max(BATCH)).first()[0]
        if batch is not None and batch <= last:
            return totals, raw.where(F.col(BATCH) <= batch), batch
    return spark.createDataFrame([], LIVE_TOTALS), raw.where(F.lit(False)), None


def batch_rates(raw: DataFrame) -> DataFrame:
    """Rows of each batch of the raw table, and rows per second since the batch
    before it arrived. There is one row per batch, so the window is small."""
    order = W.orderBy(BATCH)
    batches = raw.groupBy(BATCH).agg(
        F.count("*").alias("rows"), F.max("received_at").alias("received_at")
    )
    seconds = F.col("received_at").cast("double") - F.lag("received_at").over(order).cast("double")
    return batches.withColumn("seconds", seconds).withColumn(
        "rows_per_second", F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds"))
    )


def throughput(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Rows and rates of the batches a running query has reported lately."""
    rows = [
        (p["batchId"], p["numInputRows"], p["inputRowsPerSecond"], p["processedRowsPerSecond"])
        for p in query.recentProgress
    ]
    return spark.createDataFrame(
        rows, "batch_id long, input_rows long, arriving_per_sec double, processed_per_sec double"
    )
