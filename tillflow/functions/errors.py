"""Columns that compare a prediction with what happened."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GOOD_MAPE = 15.0  # fixed value: a mean percent error below this counts as good


def signed_error(actual: Column, predicted: Column) -> Column:
    return predicted - actual


def percent_error(actual: Column, predicted: Column) -> Column:
    """Size of the error in percent of the actual value; 0 where that is 0."""
    return F.when(actual == 0, F.lit(0.0)).otherwise(
        F.abs(signed_error(actual, predicted)) / actual * 100
    )


def direction(error: Column) -> Column:
    return F.when(error >= 0, "over").otherwise("under")


def quality(mape: Column, good_below: float = GOOD_MAPE) -> Column:
    return F.when(mape < good_below, "good").otherwise("poor")


def day_tags(is_weekend: Column, is_holiday_season: Column) -> Column:
    return F.array_compact(F.array(
        F.when(is_weekend == 1, "Weekend"),
        F.when(is_holiday_season == 1, "Holiday season"),
    ))
