"""Files and topics as targets. All writes run on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.codec import encode

#: Messages of one file of a topic, at most: some tens of megabytes for the task that writes or reads it.
FILE_MESSAGES = 500_000


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """CSV files with one header each; replaces what is there unless ``append``."""
    df.write.mode("append" if append else "overwrite").option("header", True).csv(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def publish(
    df: DataFrame, fmt: str = "kafka", key: str | None = None, **options: str
) -> None:
    """One JSON message per row to a topic."""
    encode(df, key).write.format(fmt).options(**options).mode("append").save()


def publish_files(df: DataFrame, path: str, key: str | None = None) -> None:
    """The same to files in the layout of a topic."""
    publish(df, "parquet", key, path=path)


def files_per_part(messages: int, parts: int = 1) -> int:
    """Files for each of ``parts`` equal shares of so many messages, so that no task writes or
    reads more of them, however many there are, than `FILE_MESSAGES`."""
    return max(1, -(-messages // (parts * FILE_MESSAGES)))


def json_document(df: DataFrame, **parts: Column) -> DataFrame:
    """A one-row report as one JSON text."""
    body = F.struct(*[c.alias(n) for n, c in parts.items()]) if parts else F.struct("*")
    return df.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("document"))


def preview(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)
