import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.functions import codec
from tillflow.schema import LIVE_TOTALS, MESSAGE, TRANSACTION
from tillflow.session import CHECKPOINT_DIR, emptied, new_folder, shared_root, shuffle_partitions, stored
from tillflow.sinks.files import append_rows, json_document, publish, write_csv
from tillflow.sources.files import bounded, first_rows, read_csv, read_if_exists, spread, table
from tillflow.sources.jdbc import Database


def test_shuffle_partitions_grow_with_the_data():
    assert shuffle_partitions(10**6) == 200
    assert shuffle_partitions(100 * 2**40) == 102400
    # A roll-up of 100 TB moves some kilobytes for each of 800,000 tasks.
    assert shuffle_partitions(800_000 * 200_000) == 200


def test_shared_folder_is_the_one_the_session_names(spark):
    assert new_folder(spark, "x").startswith(shared_root(spark))
    assert new_folder(spark, "x") != new_folder(spark, "x")
    named = spark.conf.get(CHECKPOINT_DIR, None)
    assert named is None or shared_root(spark) == named.rstrip("/")


def test_stored_is_written_once_and_cuts_the_lineage(spark):
    df = spark.range(10).select((F.col("id") * 2).alias("a"))
    back = stored(df, "numbers")
    assert sorted(r.a for r in back.collect()) == [2 * i for i in range(10)]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "FileScan parquet" in plan


def test_only_tables_in_few_pieces_are_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(100, numPartitions=1), spark.range(100, numPartitions=cores)
    assert spread(few).rdd.getNumPartitions() == min(cores, 8)
    assert "repartition" in spread(few)._jdf.queryExecution().analyzed().toString().lower()
    assert "repartition" not in spread(many)._jdf.queryExecution().analyzed().toString().lower()


def test_emptied_frees_the_files(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(10000, numPartitions=3).write.parquet(str(path))
    emptied(spark, str(path))
    assert spark.read.parquet(str(path)).count() == 0
    assert len(list(path.glob("*.parquet"))) == 1


def test_csv_round_trip(spark, make_tx, tmp_path):
    tx = make_tx(dict(transaction_id=1), dict(transaction_id=2, unit_price=Decimal("12.34"), date=dt.date(2022, 5, 6)))
    write_csv(tx, str(tmp_path / "c"))
    back = read_csv(spark, str(tmp_path / "c"))
    assert back.dtypes == tx.dtypes
    assert sorted(back.collect()) == sorted(tx.collect())


def test_csv_append_adds_rows_and_overwrite_replaces(spark, make_tx, tmp_path):
    path = str(tmp_path / "c")
    write_csv(make_tx(dict(transaction_id=9)), path)
    write_csv(make_tx(dict(transaction_id=1)), path)
    write_csv(make_tx(dict(transaction_id=2)), path, append=True)
    # The header of each file is no row.
    assert sorted(r.transaction_id for r in read_csv(spark, path).collect()) == [1, 2]


def test_csv_lines_that_do_not_fit_are_kept_aside(spark, tmp_path):
    file = tmp_path / "bad.csv"
    file.write_text("transaction_id,date\n1,2022-01-01\n2,bad\n")
    schema = TRANSACTION.fields[:2]
    from pyspark.sql.types import StructType
    rows = read_csv(spark, str(file), StructType(schema), bad_column="_bad").orderBy("transaction_id").collect()
    assert [(r.date, r._bad) for r in rows] == [(dt.date(2022, 1, 1), None), (None, "2,bad")]


def test_appending_keeps_duplicates(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        append_rows(spark.range(3), path)
    assert spark.read.parquet(path).count() == 6


@pytest.mark.parametrize("n, rows", [(None, 10), (0, 0), (3, 3), (50, 10)])
def test_bounded_scan(spark, n, rows):
    assert bounded(spark.range(10), n).count() == rows


def test_bounded_scan_in_order(spark):
    assert [r.id for r in bounded(spark.range(100), 3, [F.desc("id")]).collect()] == [99, 98, 97]


def test_a_table_that_is_not_there_is_empty(spark, tmp_path):
    df, found = read_if_exists(spark, str(tmp_path / "none"), LIVE_TOTALS)
    assert not found and df.isEmpty() and df.schema == LIVE_TOTALS


def test_scans_read_only_the_columns_asked_for(spark):
    df = table(spark, "/root/testdata/sf0.001", "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def test_publish_writes_one_message_per_row(spark, make_tx, tmp_path):
    tx = make_tx(*[dict(transaction_id=i) for i in range(20)])
    publish(tx, "parquet", path=str(tmp_path / "topic"))
    topic = spark.read.schema(MESSAGE).parquet(str(tmp_path / "topic"))
    assert sorted(r.transaction_id for r in codec.decode(topic).collect()) == list(range(20))


def test_json_document(spark):
    df = spark.sql("select 1 as a, cast(null as string) as b")
    assert json_document(df).first().document == '{"a":1,"b":null}'
    assert json_document(df, x=F.col("a")).first().document == '{"x":1}'


def test_database_options_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("TILLFLOW_JDBC_URL", "jdbc:x:db")
    monkeypatch.setenv("TILLFLOW_JDBC_DRIVER", "x.Driver")
    monkeypatch.setenv("TILLFLOW_JDBC_USER", "someone")
    monkeypatch.delenv("TILLFLOW_JDBC_PASSWORD", raising=False)
    database = Database.from_environment()
    assert database.options(dbtable="t") == {
        "url": "jdbc:x:db", "driver": "x.Driver", "user": "someone", "dbtable": "t",
    }


class Recorder:
    """Stands in for a writer and notes what it is told."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def mode(self, name):
        self.seen["mode"] = name
        return self

    def save(self):
        self.seen["saved"] = True


def test_database_writes_append_or_replace_in_place():
    class Frame:
        write = Recorder()

        @classmethod
        def repartition(cls, n):
            cls.writers = n
            return cls

    database = Database("jdbc:x:db", "x.Driver")
    database.append(Frame, "raw")
    assert Frame.writers == 16
    assert Frame.write.seen == {
        "format": "jdbc", "url": "jdbc:x:db", "driver": "x.Driver", "dbtable": "raw", "mode": "append", "saved": True,
        "numPartitions": "16",
    }
    Frame.write = Recorder()
    database.replace(Frame, "totals", createTableColumnTypes="region varchar(32)")
    assert Frame.write.seen["mode"] == "overwrite" and Frame.write.seen["truncate"] == "true"
    assert Frame.write.seen["createTableColumnTypes"] == "region varchar(32)"


@pytest.mark.parametrize("n", [0, 1, 7, 250, 999, 1000, 5000])
def test_first_rows_of_many_partitions(spark, tmp_path, n):
    path = str(tmp_path / "rows")
    spark.range(1000).repartition(13).write.parquet(path)
    rows = [r.id for r in first_rows(spark.read.parquet(path), n).collect()]
    assert len(rows) == len(set(rows)) == min(n, 1000) and set(rows) <= set(range(1000))


def test_first_rows_move_no_row(spark, tmp_path):
    """The only exchanges are those of the counts and their window, and of one row a partition."""
    path = str(tmp_path / "rows")
    spark.range(1000).selectExpr("id", "id % 7 as more").repartition(13).write.parquet(path)
    plan = first_rows(spark.read.parquet(path), 500)._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("more#" in line or "id#" in line for line in exchanges), exchanges
