"""Transactions to and from JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.schema import TRANSACTION

BAD = "_bad_record"
_PARSED = T.StructType(TRANSACTION.fields + [T.StructField(BAD, T.StringType())])
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}


def encode(df: DataFrame, key: str | None = None) -> DataFrame:
    """One message per row: all columns as a JSON object, dates as ISO text,
    decimals as numbers, nulls written out. Without a ``key`` the broker spreads
    the messages evenly, so no value of the data can crowd one partition."""
    row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    key_column = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(
        key_column.cast("binary").alias("key"), row.cast("binary").alias("value")
    )


def _parsed(value: Column) -> Column:
    return F.from_json(value.cast("string"), _PARSED, _OPTIONS)


def _usable(record: Column) -> Column:
    # Both tests are needed: text that is no JSON and fields of a wrong type set
    # the bad-record field; a null value or an object of unknown fields does not.
    # A sale without an id is a sale: it adds to sums and is only not counted.
    known = F.coalesce(*[record[name].cast("string") for name in TRANSACTION.fieldNames()])
    return record[BAD].isNull() & known.isNotNull()


def decode(
    messages: DataFrame, permissive: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Transactions of the messages. Messages that hold none are left out, or,
    with ``permissive``, kept as rows with nulls for what could not be read.
    ``carry`` names columns of the message, such as its offset, to keep."""
    if permissive:
        rows = messages.select(*carry, _parsed(F.col("value")).alias("_record"))
        return rows.select(*carry, "_record.*").drop(BAD)
    # The test runs over a list of one record: written as a filter on the parsed
    # column it would be pushed below it, and every message be parsed again.
    good = F.filter(F.array(_parsed(F.col("value"))), _usable)
    return messages.select(*carry, F.inline(good)).drop(BAD)


def dead_letters(messages: DataFrame) -> DataFrame:
    """The messages that hold no readable transaction, unchanged: no JSON, a field of a
    wrong type, or no field of a transaction at all."""
    return messages.where(~F.exists(F.array(_parsed(F.col("value"))), _usable))
