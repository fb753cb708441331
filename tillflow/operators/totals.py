"""Roll-ups of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import money

# The lengths of two report lists.
TOP_GROUPS = 15
RECENT_ROWS = 20


def daily_rollup(tx: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per date (and key). Ids that are null are not counted."""
    return tx.groupBy("date", *keys).agg(
        money.total(tx, "sales").alias("daily_revenue"),
        F.sum("units_sold").alias("daily_units_sold"),
        F.avg("promotion_flag").alias("promo_rate"),
        F.avg("discount_pct").alias("avg_discount_pct"),
        F.count("transaction_id").alias("transaction_count"),
    )


def group_totals(tx: DataFrame, *by: str) -> DataFrame:
    """Revenue and units per group of transactions."""
    return tx.groupBy(*by).agg(
        money.total(tx, "sales").alias("total_revenue"),
        F.sum("units_sold").alias("total_units_sold"),
    )


def merge_totals(partial: DataFrame, *by: str) -> DataFrame:
    """Totals of totals: coarser groups from finer ones."""
    return partial.groupBy(*by).agg(
        F.sum("total_revenue").cast(money.SUM).alias("total_revenue"),
        F.sum("total_units_sold").alias("total_units_sold"),
    )


def top_groups(totals: DataFrame, n: int = TOP_GROUPS) -> DataFrame:
    """The ``n`` groups of most revenue."""
    return totals.orderBy(F.desc("total_revenue"), "region", "category").limit(n)


def latest(rows: DataFrame, arrived: str, key: str, n: int = RECENT_ROWS) -> DataFrame:
    """The ``n`` rows that arrived last; ``key`` decides between equal times."""
    return rows.orderBy(F.desc(arrived), F.desc(key)).limit(n)


def live_totals(totals: DataFrame) -> DataFrame:
    """Sum over all groups, 0 if there are none."""
    return totals.agg(
        F.coalesce(F.sum("total_revenue"), F.lit(0)).cast("double").alias("total_revenue"),
        F.count("*").alias("groups"),
    )
