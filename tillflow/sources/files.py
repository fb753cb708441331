"""Tables and text files on any file system Spark can reach."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.calendar import parse_date
from tillflow.schema import TABLES, TRANSACTION

FEW_PIECES = 32


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over more cores, for costly work per row, if it comes in a few pieces
    only: a small table in one row group would leave the others idle. Any larger one
    is returned as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df.rdd.getNumPartitions()
    return df if pieces >= min(cores, FEW_PIECES) else df.repartition(min(cores, 8 * pieces))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRANSACTION,
    mode: str = "PERMISSIVE",
    bad_column: str | None = None,
    **options: str,
) -> DataFrame:
    """CSV with a header, read in one pass with a given schema. With
    ``bad_column`` the text of lines that do not fit it is kept there."""
    reader = spark.read.option("header", True).option("mode", mode).options(**options)
    if bad_column:
        schema = T.StructType(schema.fields + [T.StructField(bad_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", bad_column)
    return reader.schema(schema).csv(path)


def dated(df: DataFrame, column: str = "date") -> tuple[DataFrame, DataFrame]:
    """The rows with a readable date, parsed, and the rows without, unchanged. A
    null date would sort first and shift every lag of the series."""
    date = parse_date(F.col(column))
    return (
        df.withColumn(column, date).where(F.col(column).isNotNull()),
        df.where(date.isNull()),
    )


def bounded(df: DataFrame, n: int | None, order_by: list[Column] | None = None) -> DataFrame:
    """The first ``n`` rows, all of them for ``None``; in a given order if one is named."""
    if n is None:
        return df
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, for large ``n``: `bounded` brings an unordered limit through one task, here
    every task keeps its own share and no row is moved. Rows are counted by partition, the counts
    before each are added up, and the partition in which ``n`` is reached is cut there.

    ``df`` has to be a scan (with filters and columns at will), as it is read twice and both must
    see the same partitions. It is read in full: for a few rows `bounded` is the better one."""
    part, row = F.spark_partition_id(), F.monotonically_increasing_id()
    placed = df.withColumns({"_part": part, "_pos": row - F.shiftleft(part.cast("long"), 33)})
    counts = df.select(part.alias("_part")).groupBy("_part").agg(F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shares = counts.select("_part", (n - F.coalesce(F.sum("_rows").over(before), F.lit(0))).alias("_share"))
    # One row per partition of the scan.
    return placed.join(F.broadcast(shares.where("_share > 0")), "_part").where("_pos < _share").select(*df.columns)


def read_if_exists(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> tuple[DataFrame, bool]:
    """The table at ``path`` and whether there is one yet; if not, an empty table."""
    try:
        return spark.read.schema(schema).options(**options).parquet(path), True
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema), False


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from ``start`` to ``end``, both included."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return _days(bounds)


def date_spine_of(df: DataFrame, column: str = "date") -> DataFrame:
    """Every day from the first to the last date of a table."""
    return _days(df.agg(F.min(column).alias("start"), F.max(column).alias("end")))


def _days(bounds: DataFrame) -> DataFrame:
    day = F.expr("interval 1 day")
    return bounds.select(F.explode(F.sequence("start", "end", day)).alias("date"))
