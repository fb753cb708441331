"""Report queries over the prediction table and the live tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions import calendar, text
from tillflow.functions.money import money_as_double
from tillflow.operators.evaluate import by_date, mean, with_errors
from tillflow.operators.paging import PAGE_ROWS, newest_first
from tillflow.operators.totals import RECENT_ROWS, latest, top_groups
from tillflow.schema import LIVE_RAW, LIVE_TOTALS
from tillflow.sinks.files import json_document
from tillflow.sources.jdbc import Database

RECENT_COLUMNS = [
    "transaction_id", "date", "store_id", "region", "product_id", "category",
    "units_sold", "unit_price", "sales_amount", "received_at",
]


def prediction_page(predictions: DataFrame, wanted: object = 1, size: int = PAGE_ROWS) -> DataFrame:
    """One page of predictions with their errors, newest day first."""
    return with_errors(newest_first(predictions, wanted, size))


def weekday_profile(predictions: DataFrame) -> DataFrame:
    """Mean actual and predicted revenue of each weekday, Monday first; days
    without rows report 0."""
    week = predictions.sparkSession.range(1, 8, 1, 1).select(
        F.col("id").cast("int").alias("day_of_week_num")
    )
    # At most one row per weekday, so it may be broadcast.
    means = predictions.groupBy("day_of_week_num").agg(by_date().alias("found")).select(
        "day_of_week_num",
        mean(F.col("found"), lambda day: day["actual_revenue"]).alias("avg_actual"),
        mean(F.col("found"), lambda day: day["predicted_revenue"]).alias("avg_predicted"),
    )
    return (
        week.join(F.broadcast(means), "day_of_week_num", "left")
        .na.fill(0.0, subset=["avg_actual", "avg_predicted"])
        .withColumns({
            "sort_key": calendar.index_of_number(F.col("day_of_week_num")).cast("int"),
            "day_name": calendar.day_name_of_number(F.col("day_of_week_num")),
        })
        .orderBy("sort_key")
    )


def error_series(predictions: DataFrame) -> DataFrame:
    """Actual, predicted and error by date, oldest first."""
    return with_errors(predictions).select(
        "date", "actual_revenue", "predicted_revenue", "error", "direction"
    ).orderBy("date")


def scatter_bounds(predictions: DataFrame) -> DataFrame:
    """Ends of the diagonal in the scatter of actual against predicted."""
    return predictions.agg(
        F.min("actual_revenue").alias("actual_min"), F.max("actual_revenue").alias("actual_max")
    )


def chart_series(predictions: DataFrame) -> DataFrame:
    """The columns of the prediction table as lists in date order, in one row. The
    table holds one row per held-out day, which bounds the lists."""
    point = F.struct(
        "date", F.col("actual_revenue").alias("x"), F.col("predicted_revenue").alias("y"),
        F.round("error", 2).alias("error"),
    )
    row = with_errors(predictions).agg(F.sort_array(F.collect_list(point)).alias("points"))
    return row.select(
        (F.size("points") > 0).alias("has_data"),
        F.transform("points", lambda p: text.iso_text(p["date"])).alias("dates"),
        F.transform("points", lambda p: p["x"]).alias("actual"),
        F.transform("points", lambda p: p["y"]).alias("predicted"),
        F.transform("points", lambda p: p["error"]).alias("errors"),
        F.transform("points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("scatter"),
    )


def chart_document(predictions: DataFrame) -> DataFrame:
    """Series, weekday profile and scatter as one JSON text."""
    days = F.sort_array(F.collect_list(F.struct(
        "sort_key", "day_name",
        F.round("avg_actual", 2).alias("avg_actual"),
        F.round("avg_predicted", 2).alias("avg_predicted"),
    )))
    week = weekday_profile(predictions).agg(days.alias("days")).scalar()
    document = chart_series(predictions).withColumn("_week", week).withColumns({
        "dow_labels": F.col("_week.day_name"),
        "dow_avg_actual": F.col("_week.avg_actual"),
        "dow_avg_predicted": F.col("_week.avg_predicted"),
    }).drop("_week")
    return json_document(document)


def live_snapshot(totals: DataFrame, raw: DataFrame, has_data: bool = True) -> DataFrame:
    """The live report over the tables of the two live queries."""
    recent = latest(raw, "received_at", "transaction_id").select(*RECENT_COLUMNS)
    return _snapshot(totals, recent, raw.agg(F.count("*")), has_data)


def live_document(totals: DataFrame, raw: DataFrame, batch: int | None) -> DataFrame:
    """The live report after a batch that both tables hold (`live.read_shared`) as one JSON text:
    ISO dates, nulls kept, ``agrees`` if both tables hold the same revenue. Rows that came at
    the same time are ordered by what is shown of them, so the list does not depend on files."""
    recent = raw.select(*RECENT_COLUMNS).orderBy(
        F.desc("received_at"), *[F.desc(name) for name in RECENT_COLUMNS]).limit(RECENT_ROWS)

    def revenue(rows: DataFrame, name: str) -> Column:
        return rows.agg(F.coalesce(F.sum(name), F.lit(0)).cast("decimal(38,2)").alias("revenue")).scalar()
    report = _snapshot(totals, recent, raw.agg(F.count("*")), batch is not None)
    return json_document(report.withColumns({
        "batch_id": F.lit(batch).cast("long"),
        "agrees": revenue(totals, "total_revenue") == revenue(raw, "sales_amount"),
    }))


def database_snapshot(
    spark: SparkSession, database: Database, totals_table: str, raw_table: str
) -> DataFrame:
    """The live report over tables in a database. The raw table grows without end,
    so its latest rows and its count are found in the database."""
    if not (database.has_table(spark, totals_table) and database.has_table(spark, raw_table)):
        empty = [spark.createDataFrame([], schema) for schema in (LIVE_TOTALS, LIVE_RAW)]
        return live_snapshot(*empty, has_data=False)
    recent = database.read_query(
        spark,
        f"select {', '.join(RECENT_COLUMNS)} from {raw_table}"
        f" order by received_at desc, transaction_id desc limit {RECENT_ROWS}",
    )
    count = database.read_query(spark, f"select count(*) as n from {raw_table}")
    return _snapshot(database.read_table(spark, totals_table), recent, count, True)


def _snapshot(totals: DataFrame, recent: DataFrame, count: DataFrame, has_data: bool) -> DataFrame:
    """Top groups, latest transactions, count and revenue in one row. Both lists
    have been cut to their report length before they are collected."""
    groups = money_as_double(top_groups(totals).select(
        "region", "category", "total_revenue", "total_units_sold"
    )).withColumn("label", text.group_label(F.col("region"), F.col("category")))
    group_list = groups.agg(F.sort_array(F.collect_list(F.struct(
        F.negative("total_revenue").alias("order"), F.struct(*groups.columns).alias("row")
    ))).alias("found"))

    rows = money_as_double(recent)
    row_list = rows.agg(F.sort_array(F.collect_list(F.struct(
        "received_at", "transaction_id", F.struct(*rows.columns).alias("row")
    )), asc=False).alias("found"))

    revenue = F.coalesce(F.sum("total_revenue"), F.lit(0)).cast("double")
    return totals.agg(revenue.alias("total_revenue")).select(
        F.lit(has_data).alias("has_data"),
        group_list.select("found.row").scalar().alias("aggregates"),
        row_list.select("found.row").scalar().alias("recent"),
        count.scalar().alias("total_transactions"),
        "total_revenue",
    )
