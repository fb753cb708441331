"""Raw rows once each, whatever is restarted, repeated or begun anew.

A batch is written to a folder nobody reads, and counts when its entry is in the manifest:
one small file, named by the checkpoint's own id and the number of the batch, which can be
created only once. Readers resolve the manifest and see whole batches only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillflow.functions.codec import decode
from tillflow.schema import LIVE_RAW
from tillflow.streaming.files import checkpoint_id, created, exists
from tillflow.streaming.live import BATCH, COORDINATES, BatchSink, _started, missing_rows

ENTRY = "owner string, batch_id long, folder string, low long, high long"


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: a row for every batch that counts, with the ends of its offsets."""
    if not exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(f"{path}/manifest")


def ledger_files(
    path: str, checkpoint: str, keys: tuple[str, ...] = COORDINATES,
    decoded: Callable[[DataFrame], DataFrame] | None = None,
) -> BatchSink:
    """Appends each batch of the query with this ``checkpoint`` once.

    A batch that has its entry is left alone, so a repeated one adds nothing; one that failed
    before its entry is written anew, and what it left is in no reader's way. ``keys`` name a
    message and have to be carried by the query, the last of them its offset: messages that
    another checkpoint has brought already are left out, so that a query begun anew over the
    same topic adds only what is new. Only batches whose offsets overlap are looked at for it,
    by their keys alone. ``decoded`` makes the rows of what is left: given to a query that hands
    over its messages unread, it spares those that are left out. One query writes at a time.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        owner = checkpoint_id(spark, checkpoint)
        entry = f"{path}/manifest/{owner}-{batch_id:012d}.json"
        if exists(spark, entry):
            return
        rows, folder = batch, f"{path}/data/{owner}-{batch_id:012d}-{uuid.uuid4().hex}"
        others = [e.folder for e in _overlapping(spark, path, owner, batch, keys[-1])]
        if others:
            rows = missing_rows(rows, spark.read.parquet(*others), keys)
        rows = (decoded(rows) if decoded else rows).withColumn(BATCH, F.lit(batch_id).cast("long"))
        rows.write.parquet(folder)
        ends = spark.read.schema(rows.schema).parquet(folder).agg(F.min(keys[-1]), F.max(keys[-1])).first()
        created(spark, entry, json.dumps({
            "owner": owner, BATCH: batch_id, "folder": folder, "low": ends[0], "high": ends[1]}))

    return sink


def start_ledger(
    messages: DataFrame, path: str, checkpoint: str, name: str = "raw_ledger",
    permissive: bool = False, keys: tuple[str, ...] = COORDINATES, **trigger,
) -> StreamingQuery:
    """`live.start_raw` into the ledger, with the ``keys`` of the messages kept. A message is
    parsed only when it is known to be new: a topic read anew costs its keys."""
    def decoded(rows: DataFrame) -> DataFrame:
        return decode(rows, permissive, (*keys, "received_at"))
    return _started(
        messages.select("value", *keys), "append", ledger_files(path, checkpoint, keys, decoded), "received_at",
        name, checkpoint, trigger or {"availableNow": True}, 0)


def _overlapping(spark: SparkSession, path: str, owner: str, batch: DataFrame, offset: str) -> list:
    found = entries(spark, path).where((F.col("owner") != owner) & F.col("low").isNotNull())
    if found.isEmpty():
        return []
    low, high = batch.agg(F.min(offset), F.max(offset)).first()
    if low is None:
        return []
    return found.where((F.col("low") <= high) & (F.col("high") >= low)).select("folder").collect()


def read_ledger(
    spark: SparkSession, path: str, carried: str = "topic string, partition int, offset long",
) -> tuple[DataFrame, bool]:
    """All raw rows that count, and whether there are any batches yet. ``carried`` are the columns
    of the message that the query kept."""
    schema = T.StructType(T.StructType.fromDDL(carried).fields + LIVE_RAW.fields)
    folders = [e.folder for e in entries(spark, path).select("folder").collect()]
    if not folders:
        return spark.createDataFrame([], schema), False
    return spark.read.schema(schema).parquet(*folders), True
