import os

import pytest
from pyspark.sql import functions as F

from tillflow.plans import jobs
from tillflow.schema import PREDICTION, TRANSACTION
from tillflow.sinks.published import drop_replaced, publish_table, read_published
from tillflow.sinks.files import write_csv

NUMBERS = "id long"


def read(spark, path, version=None):
    rows, found = read_published(spark, path, spark.createDataFrame([], NUMBERS).schema, version)
    return sorted(r.id for r in rows.collect()), found


def test_readers_find_the_last_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read(spark, path) == ([], False)
    assert publish_table(spark.range(3), path) == 1
    held, _ = read_published(spark, path, spark.range(1).schema)
    assert publish_table(spark.range(5), path) == 2
    assert read(spark, path) == ([0, 1, 2, 3, 4], True) and held.count() == 3
    assert read(spark, path, 1) == ([0, 1, 2], True) and read(spark, path, 9) == ([], False)


def test_a_version_may_be_made_from_the_one_before_and_be_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_table(spark.range(3), path)
    publish_table(read_published(spark, path, spark.range(1).schema)[0].selectExpr("id + 10 as id"), path)
    assert read(spark, path) == ([10, 11, 12], True)
    publish_table(spark.range(0), path)
    assert read(spark, path) == ([], True)


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_table(spark.range(3), path)
    with pytest.raises(Exception, match="no number"):
        publish_table(spark.range(2).select(F.raise_error(F.lit("no number")).cast("long").alias("id")), path)
    assert read(spark, path) == ([0, 1, 2], True)
    assert publish_table(spark.range(1), path) == 2


def test_replaced_versions_go_after_their_time(spark, tmp_path):
    path = str(tmp_path / "t")
    assert drop_replaced(spark, path) == 0
    for n in (1, 2, 3):
        publish_table(spark.range(n), path)
    assert drop_replaced(spark, path) == 0 and read(spark, path, 1) == ([0], True)
    assert drop_replaced(spark, path, keep_hours=0) == 2
    assert read(spark, path, 1) == ([], False) and read(spark, path) == ([0, 1, 2], True)
    assert len(os.listdir(f"{path}/versions")) == 1
    assert publish_table(spark.range(4), path) == 4


def test_training_publishes_and_tells_of_lines_without_a_date(spark, make_tx, tmp_path):
    source, rejects, target = (str(tmp_path / n) for n in ("csv", "rejects", "predictions"))
    rows = make_tx(*[dict(transaction_id=i) for i in range(60)]).withColumn(
        "date", F.when(F.col("transaction_id") != 59, F.expr("date_add(date'2024-01-01', cast(transaction_id as int))")))
    write_csv(rows, source)
    predictions, _, _ = jobs.train_from_csv(spark, source, test_days=10, rejects=rejects, target=target, trees=2)
    found, there = read_published(spark, target, PREDICTION)
    assert there and sorted(found.collect()) == sorted(predictions.collect()) and found.count() == 10
    lines = [r.value for r in spark.read.text(rejects).collect() if r.value]
    assert len(lines) == 1 and lines[0].startswith("59,") and lines[0].count(",") == len(TRANSACTION) - 1
    with pytest.raises(Exception, match="has no date"):
        jobs.train_from_csv(spark, source, test_days=10, trees=2)
