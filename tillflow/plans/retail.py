"""Transactions from the order tables.

A sale line is priced through its product and placed through its store. All joins
are left joins on a unique key; no line is lost. Each roll-up joins only what it
needs: prices for the daily series, and stores after the lines are summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions import calendar, money, text
from tillflow.operators.lookups import lookup
from tillflow.operators.totals import daily_rollup, group_totals, merge_totals
from tillflow.schema import TRANSACTION
from tillflow.sources.files import spread, table


def sale_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Sale lines as written, under the numeric keys ``store_key`` and ``product_key``."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").alias("store_key"),
        F.col("l_partkey").alias("product_key"),
        F.col("l_quantity").cast("int").alias("units_sold"),
        F.col("l_discount").alias("discount_rate"),
    )


def with_promotion(lines: DataFrame) -> DataFrame:
    """Flag and whole percent of the discount in place of its rate."""
    rate = F.col("discount_rate")
    return lines.withColumn("promotion_flag", F.when(rate > 0, 1).otherwise(0)).withColumn(
        "discount_pct",
        money.promoted_discount(F.col("promotion_flag"), F.round(rate * 100).cast("int")),
    ).drop("discount_rate")


def priced(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Sale lines with category and amount in cents. What follows from a line's own columns
    is derived after the join, which then has fewer columns to move if it has to shuffle."""
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_type").alias("category"),
        money.cents(F.col("p_retailprice")).alias("unit_cents"),
    )
    return with_promotion(lookup(lines, products, "product_key")).withColumn(
        "sales_cents",
        money.discounted_cents(F.col("units_sold"), F.col("unit_cents"), F.col("discount_pct")),
    )


def priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Enough for any roll-up without regions."""
    return priced(sale_lines(spark, folder), spark, folder)


def stores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("store_key"), F.col("s_nationkey").alias("nation_key")
    )


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Nations with the name of their region. Spark broadcasts the short list if its files
    are below the threshold."""
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_regionkey").alias("region_key")
    )
    regions = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("region_key"), F.col("r_name").alias("region")
    )
    return lookup(nations, regions, "region_key").drop("region_key")


def with_region(df: DataFrame, stores: DataFrame, places: DataFrame) -> DataFrame:
    """Adds the region of ``store_key``."""
    placed = lookup(lookup(df, stores, "store_key"), places, "nation_key")
    return placed.drop("nation_key")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The full transaction table, one row per sale line."""
    lines = priced(spread(sale_lines(spark, folder)), spark, folder)
    return (
        with_region(lines, stores(spark, folder), places(spark, folder))
        .withColumns({
            "day_of_week": calendar.day_name(F.col("date")),
            "store_id": text.padded_key("S", F.col("store_key"), 3),
            "product_id": text.padded_key("P", F.col("product_key"), 4),
            "unit_price": money.from_cents(F.col("unit_cents")),
            "sales_amount": money.from_cents(F.col("sales_cents")),
        })
        .select(*TRANSACTION.fieldNames())
    )


def daily_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return daily_rollup(priced_lines(spark, folder))


def region_category_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals per region and category. The lines are summed per store and category
    first: what meets the store table is a few rows per store, however many lines one has."""
    lines, by_key = priced_lines(spark, folder), stores(spark, folder)
    per_store = group_totals(lines, "store_key", "category")
    placed = with_region(per_store, by_key, places(spark, folder))
    return merge_totals(placed, "region", "category")
