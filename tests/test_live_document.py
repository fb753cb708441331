import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.operators.totals import group_totals
from tillflow.plans import reports
from tillflow.streaming import live

NOON = dt.datetime(2024, 1, 1, 12)


@pytest.fixture
def targets(tmp_path, make_tx):
    """Writes batch ``n`` to one target or the other; each batch brings three sales of 10."""
    totals_path, raw_path = str(tmp_path / "totals"), str(tmp_path / "raw")

    def batch(n):
        return make_tx(*[dict(transaction_id=3 * n + i, sales_amount=Decimal("10.00"),
                              date=None if i == 2 else dt.date(2024, 1, 1 + n)) for i in range(3)])

    def raw(n, run="0"):
        live.raw_files(raw_path, run)(batch(n).withColumn("received_at", F.lit(NOON + dt.timedelta(minutes=n))), n)

    def totals(n):
        seen = batch(0)
        for k in range(1, n + 1):
            seen = seen.unionByName(batch(k))
        live.totals_files(totals_path)(
            group_totals(seen, "region", "category").withColumn("updated_at", F.lit(NOON)), n)
    return totals_path, raw_path, totals, raw


def document(spark, totals_path, raw_path, run="0"):
    rows = reports.live_document(*live.read_shared(spark, totals_path, raw_path, run)).collect()
    assert len(rows) == 1
    return json.loads(rows[0].document)


@pytest.mark.parametrize("summed, arrived", [(3, 2), (2, 3), (2, 2)])
def test_the_report_is_of_the_last_batch_of_both(spark, targets, summed, arrived):
    totals_path, raw_path, totals, raw = targets
    for n in range(summed):
        totals(n)
    for n in range(arrived):
        raw(n)
    told = document(spark, totals_path, raw_path)
    assert (told["has_data"], told["batch_id"], told["agrees"]) == (True, 1, True)
    assert (told["total_transactions"], told["total_revenue"]) == (6, 60.0)
    assert [r["transaction_id"] for r in told["recent"]] == [5, 4, 3, 2, 1, 0]
    assert told["recent"][1]["date"] == "2024-01-02" and told["recent"][0]["date"] is None
    assert told["recent"][0]["received_at"].startswith("2024-01-01T12:01:00")
    assert told["aggregates"][0] | {"total_revenue": 60.0, "label": "North / Toys"} == told["aggregates"][0]


def test_no_shared_batch_tells_nothing(spark, targets):
    totals_path, raw_path, totals, raw = targets
    assert document(spark, totals_path, raw_path)["has_data"] is False
    totals(0)
    told = document(spark, totals_path, raw_path)
    assert told["has_data"] is False and told["batch_id"] is None
    assert (told["aggregates"], told["recent"], told["total_transactions"], told["total_revenue"]) == ([], [], 0, 0.0)
    raw(0, run="another")
    assert document(spark, totals_path, raw_path)["has_data"] is False
    assert document(spark, totals_path, raw_path, "another")["total_transactions"] == 3


def test_lost_raw_rows_are_told(spark, targets, make_tx):
    totals_path, raw_path, totals, raw = targets
    totals(0)
    live.raw_files(raw_path)(make_tx(dict(transaction_id=1)).withColumn("received_at", F.lit(NOON)), 0)
    assert document(spark, totals_path, raw_path)["agrees"] is False


def test_more_rows_than_the_report_shows(spark, targets, make_tx):
    totals_path, raw_path, totals, raw = targets
    rows = make_tx(*[dict(transaction_id=7, product_id=f"P{i:04d}", category=f"C{i % 18:02d}") for i in range(30)])
    live.raw_files(raw_path)(rows.withColumn("received_at", F.lit(NOON)).repartition(7), 0)
    live.totals_files(totals_path)(
        group_totals(rows, "region", "category").withColumn("updated_at", F.lit(NOON)), 0)
    told = document(spark, totals_path, raw_path)
    assert [r["product_id"] for r in told["recent"]] == [f"P{i:04d}" for i in range(29, 9, -1)]
    assert len(told["aggregates"]) == 15 and told["agrees"] is True
