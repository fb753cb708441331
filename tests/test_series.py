from decimal import Decimal

import pytest
from conftest import days
from pyspark.sql import functions as F

from tillflow.operators import features, split, totals
from tillflow.sources.files import date_spine, date_spine_of


def test_daily_rollup_skips_null_ids_in_the_count_only(make_tx):
    tx = make_tx(
        dict(transaction_id=1, units_sold=2, promotion_flag=1, discount_pct=10, sales_amount=Decimal("5.25")),
        dict(transaction_id=None, units_sold=3, sales_amount=Decimal("1.50")),
    )
    row = totals.daily_rollup(tx).first()
    assert (row.daily_revenue, row.daily_units_sold, row.transaction_count) == (Decimal("6.75"), 5, 1)
    assert (row.promo_rate, row.avg_discount_pct) == (0.5, 5.0)


def test_totals_from_cents_equal_totals_from_decimals(make_tx):
    tx = make_tx(*[dict(date=None if i % 7 == 0 else tx_date(i), sales_amount=Decimal(i) / 100) for i in range(50)])
    cents = tx.withColumn("sales_cents", (F.col("sales_amount") * 100).cast("long")).drop("sales_amount")
    a, b = totals.daily_rollup(tx), totals.daily_rollup(cents)
    assert a.dtypes == b.dtypes
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def tx_date(i):
    import datetime as dt
    return dt.date(2024, 1, 1 + i % 5)


def test_merged_partial_totals_equal_totals(make_tx):
    tx = make_tx(*[
        dict(store_id=f"S{i % 4}", region="NSEW"[i % 2], category="AB"[i % 3 % 2], sales_amount=Decimal(i))
        for i in range(40)
    ])
    fine = totals.group_totals(tx, "store_id", "region", "category")
    merged = totals.merge_totals(fine, "region", "category")
    direct = totals.group_totals(tx, "region", "category")
    assert {tuple(map(str, r)) for r in merged.collect()} == {tuple(map(str, r)) for r in direct.collect()}


def test_rolling_mean_of_ten_days(make_daily):
    daily = make_daily(*zip(days("2024-01-01", 10), range(1, 11)))
    rows = features.with_history(daily).orderBy("date").collect()
    assert [r.prev_day_revenue for r in rows] == [None, *range(1, 10)]
    mean = [r.rolling_7day_avg_revenue for r in rows]
    assert mean[0] is None and mean[1] == 1.0 and mean[7] == 4.0 and mean[8] == 5.0 and mean[9] == 6.0


def test_exactly_one_warm_up_row_is_dropped(make_daily):
    daily = make_daily(*zip(days("2024-01-01", 10), range(1, 11)))
    found = features.daily_features(daily)
    assert found.count() == 9
    assert str(found.agg(F.min("date")).first()[0]) == "2024-01-02"


def test_frames_count_rows_not_days(make_daily):
    daily = make_daily(("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-05", 5), ("2024-01-09", 9))
    rows = features.with_history(daily).orderBy("date").collect()
    assert [r.prev_day_revenue for r in rows] == [None, 1, 2, 5]
    assert rows[3].rolling_7day_avg_revenue == pytest.approx(8 / 3, rel=1e-15)


def test_series_per_key_do_not_mix(spark, make_daily):
    a = make_daily(*zip(days("2024-01-01", 3), (1, 2, 3))).withColumn("store_id", F.lit("A"))
    b = make_daily(*zip(days("2024-01-01", 3), (10, 20, 30))).withColumn("store_id", F.lit("B"))
    rows = features.with_history(a.unionByName(b), ("store_id",)).orderBy("store_id", "date").collect()
    assert [r.prev_day_revenue for r in rows] == [None, 1, 2, None, 10, 20]
    parts = split.holdout(a.unionByName(b), 1, ("store_id",))
    assert {(r.store_id, r.idx) for r in parts.where("part = 'test'").collect()} == {("A", 2), ("B", 2)}


def test_missing_days_become_zero(make_daily):
    daily = make_daily(("2024-01-01", 1), ("2024-01-04", 4))
    filled = features.fill_missing_days(daily, date_spine_of(daily)).orderBy("date").collect()
    assert [float(r.daily_revenue) for r in filled] == [1, 0, 0, 4]


def test_spine_includes_both_ends(spark):
    assert date_spine(spark, "2022-01-01", "2026-12-31").count() == 1826


@pytest.mark.parametrize("n", [0, 1, 4, 9, 20])
def test_holdout_is_the_last_rows(make_daily, n):
    daily = make_daily(*zip(days("2024-01-01", 9), range(9)))
    parts = split.holdout(daily, n)
    train, test = split.train_part(parts), split.test_part(parts)
    assert test.count() == min(n, 9) and train.count() == max(0, 9 - n)
    assert train.columns == daily.columns
    if 0 < n < 9:
        assert train.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]


def test_top_and_latest_have_a_second_sort_key(spark):
    df = spark.createDataFrame(
        [("N", "A", 5), ("N", "B", 5), ("S", "A", 5), ("S", "B", 9)], "region string, category string, total_revenue int"
    )
    top = totals.top_groups(df, 3).collect()
    assert [(r.region, r.category) for r in top] == [("S", "B"), ("N", "A"), ("N", "B")]
    rows = spark.createDataFrame([(i, 7) for i in range(10)], "transaction_id long, received_at int")
    assert [r.transaction_id for r in totals.latest(rows, "received_at", "transaction_id", 3).collect()] == [9, 8, 7]


def test_live_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "total_revenue decimal(28,2)")
    assert tuple(totals.live_totals(empty).first()) == (0.0, 0)
