"""A table that is published whole: readers see one finished version, old or new.

Each version is a folder of its own; the pointer is the last of a row of small files, each of
which can be created only once.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillflow.streaming.files import created, listed, removed

VERSION = "version long, folder string, at double"


def _pointers(spark: SparkSession, path: str) -> list[str]:
    return listed(spark, f"{path}/pointers/*.json")


def _number(pointer: str) -> int:
    return int(pointer.rsplit("/", 1)[-1].removesuffix(".json"))


def publish_table(df: DataFrame, path: str) -> int:
    """Writes ``df`` as the next version and returns its number, 1 for the first. A write that
    fails leaves the version before in place; of two at once both count, one after the other."""
    spark = df.sparkSession
    folder = f"{path}/versions/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    pointers = _pointers(spark, path)
    number = _number(pointers[-1]) + 1 if pointers else 1
    while not created(spark, f"{path}/pointers/{number:012d}.json", json.dumps(
            {"version": number, "folder": folder, "at": time.time()})):
        number += 1
    return number


def read_published(
    spark: SparkSession, path: str, schema: T.StructType, version: int | None = None
) -> tuple[DataFrame, bool]:
    """The last version, or a given one, and whether it is there; if not, an empty table. What
    is returned stays the same table when another version is published meanwhile."""
    pointers = [p for p in _pointers(spark, path) if version in (None, _number(p))]
    if not pointers:
        return spark.createDataFrame([], schema), False
    folder = spark.read.schema(VERSION).json(pointers[-1]).first().folder
    return spark.read.schema(schema).parquet(folder), True


def drop_replaced(spark: SparkSession, path: str, keep_hours: float = 24.0) -> int:
    """Deletes versions that were replaced more than ``keep_hours`` ago, which is how long a reader
    may hold one. The last version always stays. Returns how many went."""
    pointers = _pointers(spark, path)
    if not pointers:
        return 0
    found = spark.read.schema(VERSION).json(pointers).orderBy("version").collect()
    before = time.time() - keep_hours * 3600
    old = [v for v, following in zip(found, found[1:]) if following["at"] < before]
    for v in old:
        removed(spark, f"{path}/pointers/{v.version:012d}.json")
        removed(spark, v.folder)
    return len(old)
