"""Calendar columns. Two weekday numberings are in use and kept apart by name:
``day_number`` counts 1 = Sunday .. 7 = Saturday, ``day_index`` 0 = Monday .. 6 = Sunday.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]  # by day_index
WEEKDAY_FACTORS = [0.9, 0.85, 0.9, 0.95, 1.2, 1.5, 1.3]  # by day_index
WEEKEND_NUMBERS = [1, 7]  # Sunday and Saturday as day_number
HOLIDAY_MONTHS = [11, 12]
HOLIDAY_FACTOR = 1.6
MIDYEAR_MONTH = 7
MIDYEAR_FACTOR = 1.15


def _pick(values: list, position: Column) -> Column:
    """The value at a zero-based position of a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), position + 1)


def parse_date(text: Column) -> Column:
    """ISO text (or a date) to a date; text that is no date becomes null."""
    return F.try_to_date(text)


def day_number(date: Column) -> Column:
    return F.dayofweek(date)


def day_index(date: Column) -> Column:
    return F.weekday(date)


def index_of_number(number: Column) -> Column:
    """From 1 = Sunday to 0 = Monday."""
    return F.pmod(number + 5, F.lit(7))


def day_name(date: Column) -> Column:
    return _pick(DAY_NAMES, day_index(date))


def day_name_of_number(number: Column) -> Column:
    return _pick(DAY_NAMES, index_of_number(number))


def weekend_flag(number: Column) -> Column:
    return F.when(number.isin(WEEKEND_NUMBERS), 1).otherwise(0)


def holiday_flag(month: Column) -> Column:
    return F.when(month.isin(HOLIDAY_MONTHS), 1).otherwise(0)


def weekday_factor(date: Column) -> Column:
    return _pick(WEEKDAY_FACTORS, day_index(date))


def season_factor(date: Column) -> Column:
    month = F.month(date)
    return (
        F.when(month.isin(HOLIDAY_MONTHS), F.lit(HOLIDAY_FACTOR))
        .when(month == MIDYEAR_MONTH, F.lit(MIDYEAR_FACTOR))
        .otherwise(F.lit(1.0))
    )
