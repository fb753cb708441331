"""Daily series to model inputs.

The series has one row per date, so a window over all of it stays as small as
the calendar however many facts there are. With ``keys`` there is one series per
key and each is a window partition of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.functions import calendar

ROLLING_ROWS = 7  # fixed value: rows before the current one in the rolling mean


def _series(keys: tuple[str, ...]):
    return W.partitionBy(*keys).orderBy("date")


def with_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "day_of_week_num": calendar.day_number(F.col("date")),
        "month_num": F.month("date"),
    }).withColumns({
        "is_weekend": calendar.weekend_flag(F.col("day_of_week_num")),
        "is_holiday_season": calendar.holiday_flag(F.col("month_num")),
    })


def with_history(daily: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Revenue of the row before and mean revenue of up to seven rows before.

    Frames count rows, not days. The mean is an exact sum over a count, so it is
    the same wherever the rows were read from.
    """
    order = _series(keys)
    before = order.rowsBetween(-ROLLING_ROWS, -1)
    revenue = F.col("daily_revenue")
    return daily.withColumns({
        "prev_day_revenue": F.lag(revenue, 1).over(order),
        "_sum": F.sum(revenue).over(before),
        "_rows": F.count(revenue).over(before),
    }).withColumn(
        "rolling_7day_avg_revenue",
        F.when(F.col("_rows") > 0, F.col("_sum").cast("double") / F.col("_rows")),
    ).drop("_sum", "_rows")


def with_calendar_frame(daily: DataFrame, days: int = ROLLING_ROWS, keys: tuple[str, ...] = ()) -> DataFrame:
    """Revenue of the ``days`` calendar days before each row: its mean over the days that have
    any, their number, and the sum over all of them. Unlike the frame of rows, a gap in the series
    does not reach further back, and days without a row count as nothing sold in the mean over all."""
    before = W.partitionBy(*keys).orderBy(F.unix_date("date")).rangeBetween(-days, -1)
    revenue = F.col("daily_revenue")
    return daily.withColumns({
        "_sum": F.sum(revenue).over(before),
        "days_sold": F.count(revenue).over(before),
    }).withColumns({
        "window_revenue": F.coalesce(F.col("_sum").cast("double"), F.lit(0.0)),
        "mean_of_days_sold": F.when(F.col("days_sold") > 0, F.col("_sum").cast("double") / F.col("days_sold")),
        "mean_of_days": F.coalesce(F.col("_sum").cast("double"), F.lit(0.0)) / days,
    }).drop("_sum")


def drop_warm_up(df: DataFrame) -> DataFrame:
    """Without the rows that have no history: the first of each series."""
    return df.na.drop(subset=["prev_day_revenue", "rolling_7day_avg_revenue"])


def daily_features(daily: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return drop_warm_up(with_history(with_calendar(daily), keys))


def fill_missing_days(daily: DataFrame, spine: DataFrame) -> DataFrame:
    """A row for every day of the spine, with zeros where nothing was sold."""
    values = [c for c in daily.columns if c != "date"]
    return spine.join(daily, "date", "left").na.fill(0, subset=values)
