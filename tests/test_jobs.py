import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tillflow.functions.codec import decode
from tillflow.plans import forecast, jobs, retail
from tillflow.schema import MESSAGE
from tillflow.sinks.files import write_csv
from tillflow.sources.files import dated


@pytest.fixture(scope="module")
def csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sales") / "csv")
    write_csv(retail.transactions(spark, SMALL), path)
    return path


def test_training_from_csv_equals_training_from_tables(spark, csv):
    predictions, metrics, importances = jobs.train_from_csv(spark, csv, trees=5)
    _, expected = forecast.train_and_predict(retail.daily_revenue(spark, SMALL), trees=5)
    assert sorted(predictions.collect()) == sorted(expected.collect())
    assert metrics.first().days == 180
    assert importances.count() == 10


@pytest.mark.parametrize("limit, rows", [(None, None), (0, 0), (25, 25)])
def test_publishing_from_csv(spark, csv, tmp_path, limit, rows):
    jobs.publish_csv(spark, csv, "parquet", limit, path=str(tmp_path / "topic"))
    messages = spark.read.schema(MESSAGE).parquet(str(tmp_path / "topic"))
    assert decode(messages).count() == (retail.transactions(spark, SMALL).count() if rows is None else rows)


def test_rows_without_a_date_go_aside(spark):
    df = spark.createDataFrame([(1, "2022-01-01"), (2, "bad"), (3, None)], "id int, date string")
    good, bad = dated(df)
    assert good.dtypes == [("id", "int"), ("date", "date")]
    assert [r.id for r in good.collect()] == [1]
    assert [(r.id, r.date) for r in bad.orderBy("id").collect()] == [(2, "bad"), (3, None)]


def test_dates_that_are_dates_already_are_kept(spark):
    df = spark.range(3).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("date"))
    good, bad = dated(df)
    assert good.count() == 3 and bad.isEmpty()
