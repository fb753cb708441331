"""How good a prediction table is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions import errors

ACTUAL = "actual_revenue"
PREDICTED = "predicted_revenue"


def with_errors(predictions: DataFrame) -> DataFrame:
    actual, predicted = F.col(ACTUAL), F.col(PREDICTED)
    return predictions.withColumns({
        "error": errors.signed_error(actual, predicted),
        "abs_percent_error": errors.percent_error(actual, predicted),
    }).withColumns({
        "direction": errors.direction(F.col("error")),
        "tags": errors.day_tags(F.col("is_weekend"), F.col("is_holiday_season")),
    })


def by_date(*more: Column) -> Column:
    """The days of a prediction table as a list in date order, to be added up in that order:
    a sum of doubles then does not depend on how the table is split. The table has a row for
    each held-out day, which bounds the list."""
    return F.sort_array(F.collect_list(F.struct("date", ACTUAL, PREDICTED, *more)))


def total(days: Column, value: Callable[[Column], Column]) -> Column:
    """The sum of a value over the days in their order; null without a day."""
    added = F.aggregate(days, F.lit(0.0), lambda s, day: s + F.coalesce(value(day), F.lit(0.0)))
    return F.when(F.size(days) > 0, added)


def mean(days: Column, value: Callable[[Column], Column]) -> Column:
    there = F.size(F.filter(days, lambda day: value(day).isNotNull()))
    return F.when(there > 0, total(days, value) / there)


def _error(day: Column) -> Column:
    return errors.signed_error(day[ACTUAL], day[PREDICTED])


def _percent(day: Column) -> Column:
    return errors.percent_error(day[ACTUAL], day[PREDICTED])


def metrics(predictions: DataFrame) -> DataFrame:
    """One row: number of days, RMSE, MAE, R squared, MAPE and its class."""
    found = predictions.agg(by_date().alias("found"))
    days = F.col("found")
    centred = found.withColumn("centre", mean(days, lambda day: day[ACTUAL]))
    spread = total(days, lambda day: (day[ACTUAL] - F.col("centre")) * (day[ACTUAL] - F.col("centre")))
    return centred.withColumn("spread", spread).select(
        F.size(days).cast("long").alias("days"),
        F.sqrt(mean(days, lambda day: _error(day) * _error(day))).alias("rmse"),
        mean(days, lambda day: F.abs(_error(day))).alias("mae"),
        F.when(
            F.col("spread") != 0, 1 - total(days, lambda day: _error(day) * _error(day)) / F.col("spread"),
        ).alias("r2"),
        F.coalesce(mean(days, _percent), F.lit(0.0)).alias("mape"),
    ).withColumn("quality", errors.quality(F.col("mape")))


def overview(predictions: DataFrame) -> DataFrame:
    """The figures of the overview report in one pass and one row, also when the
    table is empty (``has_data`` tells). Of days with equal error the earlier one
    is the best, and the worst."""
    actual, predicted = F.col(ACTUAL), F.col(PREDICTED)
    ape = errors.percent_error(actual, predicted)
    day = F.struct("date", ACTUAL, PREDICTED, ape.alias("abs_percent_error"))
    earliest_last = F.negative(F.unix_date("date"))
    summary = predictions.agg(
        F.count("*").alias("days"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        by_date().alias("found"),
        F.min_by(day, F.struct(ape, F.col("date"))).alias("best"),
        F.max_by(day, F.struct(ape, earliest_last)).alias("worst"),
    )
    days = F.col("found")
    summary = summary.withColumns({
        "total_actual": total(days, lambda day: day[ACTUAL]),
        "total_predicted": total(days, lambda day: day[PREDICTED]),
        "avg_actual": mean(days, lambda day: day[ACTUAL]),
        "avg_predicted": mean(days, lambda day: day[PREDICTED]),
        "mape": F.coalesce(mean(days, _percent), F.lit(0.0)),
    }).drop("found")
    found = {
        f"{which}_{short}": F.col(f"{which}.{name}")
        for which in ("best", "worst")
        for short, name in (("date", "date"), ("actual", ACTUAL), ("predicted", PREDICTED),
                            ("percent_error", "abs_percent_error"))
    }
    return summary.withColumns({
        "has_data": F.col("days") > 0, "quality": errors.quality(F.col("mape")), **found,
    }).drop("best", "worst")
