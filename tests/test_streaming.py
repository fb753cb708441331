import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.functions import codec
from tillflow.operators.totals import group_totals
from tillflow.plans import queries
from tillflow.plans.jobs import start_live
from tillflow.plans.reports import database_snapshot, live_snapshot
from tillflow.schema import LIVE_RAW, LIVE_TOTALS, MESSAGE, TABLES, TRANSACTION
from tillflow.sinks import files as files_sink
from tillflow.sinks.files import append_rows, publish, publish_files
from tillflow.sources.files import read_if_exists
from tillflow.sources.jdbc import Database
from tillflow.streaming import live
from tillflow.streaming.files import listed


def rows(first, n):
    return [
        dict(transaction_id=i, region="NSEW"[i % 4], category="AB"[i % 2], units_sold=i % 5 + 1,
             sales_amount=Decimal(i * 37 % 1000) / 100)
        for i in range(first, first + n)
    ]


def name():
    return f"q{uuid.uuid4().hex}"


def run_raw(spark, path, **options):
    query = live.start_raw(
        live.file_stream(spark, f"{path}/topic", **options), live.raw_files(f"{path}/raw"),
        f"{path}/raw-checkpoint", name(),
    )
    live.run_to_end(query)
    return query


def run_totals(spark, path, **options):
    query = live.start_totals(
        live.file_stream(spark, f"{path}/topic", **options), live.totals_files(f"{path}/totals"),
        f"{path}/totals-checkpoint", name(),
    )
    live.run_to_end(query)
    return query


def totals(spark, path):
    found, _ = live.read_totals(spark, f"{path}/totals")
    return {(r.region, r.category): (r.total_revenue, r.total_units_sold) for r in found.collect()}


def expected(tx):
    return {
        (r.region, r.category): (r.total_revenue, r.total_units_sold)
        for r in group_totals(tx, "region", "category").collect()
    }


@pytest.mark.parametrize("files", [1, 2, 4])
def test_stream_equals_batch(spark, make_tx, tmp_path, files):
    path = str(tmp_path)
    all_rows = rows(0, 40)
    for i in range(files):
        publish(make_tx(*all_rows[i::files]).coalesce(1), "parquet", path=f"{path}/topic")
    query = run_totals(spark, path, maxFilesPerTrigger="1")
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == files
    assert totals(spark, path) == expected(make_tx(*all_rows))


def test_restart_goes_on_and_doubles_nothing(spark, make_tx, tmp_path):
    path = str(tmp_path)
    publish(make_tx(*rows(0, 30)), "parquet", path=f"{path}/topic")
    run_raw(spark, path)
    run_totals(spark, path)
    publish(make_tx(*rows(30, 25)), "parquet", path=f"{path}/topic")
    for _ in range(2):  # the second time there is nothing new
        run_raw(spark, path)
        run_totals(spark, path)
    raw, found = live.read_raw(spark, f"{path}/raw")
    assert found and sorted(r.transaction_id for r in raw.collect()) == list(range(55))
    assert totals(spark, path) == expected(make_tx(*rows(0, 55)))


def test_a_repeated_batch_replaces_itself(spark, make_tx, tmp_path):
    path = str(tmp_path)
    stamp = F.current_timestamp()
    raw = live.raw_files(f"{path}/raw")
    for n in (5, 8):  # the first try of batch 3 has written only a part
        raw(make_tx(*rows(0, n)).withColumn("received_at", stamp), 3)
    assert live.read_raw(spark, f"{path}/raw")[0].count() == 8

    sums = live.totals_files(f"{path}/totals")
    for batch_id, n in enumerate((3, 10, 20, 30, 40)):
        frame = group_totals(make_tx(*rows(0, n)), "region", "category").withColumn("updated_at", stamp)
        sums(frame, batch_id)
        sums(frame, batch_id)
        assert totals(spark, path) == expected(make_tx(*rows(0, n)))
    assert len(list((tmp_path / "totals").glob("state-*"))) == 10


def test_rows_already_written_to_a_database_are_left_out(spark):
    batch = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (1, 1, "c")], "partition int, offset long, x string")
    left = live.missing_rows(batch, batch.where("x = 'b'"), ("partition", "offset"))
    assert sorted(r.x for r in left.collect()) == ["a", "c"]


class FolderDatabase(Database):
    """Keeps its tables as files, to follow what the sinks ask of a database."""

    def path(self, name):
        return f"{self.url}/{name}"

    def has_table(self, spark, name):
        return read_if_exists(spark, self.path(name), LIVE_RAW)[1]

    def read_table(self, spark, name):
        return spark.read.parquet(self.path(name))

    def read_query(self, spark, sql):
        for name in ("raw", "totals"):
            if self.has_table(spark, name):
                self.read_table(spark, name).createOrReplaceTempView(name)
        return spark.sql(sql)

    def append(self, df, name, **more):
        append_rows(df, self.path(name))

    def replace(self, df, name, **more):
        df.write.mode("overwrite").parquet(self.path(name))


def test_database_tables_survive_a_repeated_batch(spark, make_tx, tmp_path):
    database = FolderDatabase(str(tmp_path / "db"), "none")
    before = database_snapshot(spark, database, "totals", "raw").first()
    assert tuple(before) == (False, [], [], 0, 0.0)

    topic = f"{tmp_path}/topic"
    publish(make_tx(*rows(0, 40)), "parquet", key="transaction_id", path=topic)
    raw, sums = start_live(
        live.file_stream(spark, topic), live.raw_database(database, "raw", ("key",)),
        live.totals_database(database, "totals"), f"{tmp_path}/checkpoint", carry=("key",),
    )
    live.run_to_end(raw, sums)
    assert database.read_table(spark, "raw").count() == 40

    # Batch 0 comes again, after a first try that was cut off half way.
    again = database.read_table(spark, "raw").drop("batch_id").cache()
    again.count()
    other = FolderDatabase(str(tmp_path / "db2"), "none")
    other.append(again.where("transaction_id < 13").withColumn("batch_id", F.lit(0).cast("long")), "raw")
    live.raw_database(other, "raw", ("key",))(again, 0)
    assert sorted(r.transaction_id for r in other.read_table(spark, "raw").collect()) == list(range(40))

    found = database_snapshot(spark, database, "totals", "raw").first()
    assert found.has_data and found.total_transactions == 40 and len(found.aggregates) == 4
    assert [r.transaction_id for r in found.recent] == list(range(39, 19, -1))


def test_unreadable_messages_stay_out_of_the_state(spark, make_tx, tmp_path):
    path = str(tmp_path)
    bad = spark.createDataFrame([(None, bytearray(b"notjson")), (None, None)], MESSAGE)
    publish(make_tx(*rows(0, 8)), "parquet", path=f"{path}/topic")
    append_rows(bad, f"{path}/topic")
    run_totals(spark, path)
    run_raw(spark, path)
    assert totals(spark, path) == expected(make_tx(*rows(0, 8)))
    assert live.read_raw(spark, f"{path}/raw")[0].count() == 8
    assert codec.dead_letters(spark.read.schema(MESSAGE).parquet(f"{path}/topic")).count() == 2


def test_permissive_totals_have_a_null_group(spark, make_tx, tmp_path):
    path = str(tmp_path)
    append_rows(spark.createDataFrame([(None, bytearray(b"notjson"))], MESSAGE), f"{path}/topic")
    publish(make_tx(*rows(0, 4)), "parquet", path=f"{path}/topic")
    live.run_to_end(live.start_totals(
        live.file_stream(spark, f"{path}/topic"), live.totals_files(f"{path}/totals"),
        f"{path}/c", name(), permissive=True,
    ))
    assert totals(spark, path)[(None, None)] == (None, None)


def test_batch_without_readable_rows_adds_none(spark, tmp_path):
    path = str(tmp_path)
    append_rows(spark.createDataFrame([(None, bytearray(b"notjson"))], MESSAGE), f"{path}/topic")
    run_raw(spark, path)
    run_totals(spark, path)
    assert live.read_raw(spark, f"{path}/raw")[0].count() == 0
    assert live.read_totals(spark, f"{path}/totals")[1] is False


def test_both_queries_run_together(spark, make_tx, tmp_path):
    path = str(tmp_path)
    publish(make_tx(*rows(0, 16)), "parquet", path=f"{path}/topic")
    stream = live.file_stream(spark, f"{path}/topic")
    spark.streams.resetTerminated()
    raw = live.start_raw(stream, live.raw_files(f"{path}/raw"), f"{path}/c1", name())
    sums = live.start_totals(
        stream, live.totals_files(f"{path}/totals"), f"{path}/c2", name(), processingTime="1 second",
    )
    sums.processAllAvailable()
    live.run_together(raw, sums)
    assert not raw.isActive and not sums.isActive
    assert totals(spark, path) == expected(make_tx(*rows(0, 16)))


def test_throughput_counts_the_rows(spark, make_tx, tmp_path):
    path = str(tmp_path)
    for first, n in ((0, 12), (12, 5)):
        publish_files(make_tx(*rows(first, n)).coalesce(1), f"{path}/topic")
    query = run_raw(spark, path, maxFilesPerTrigger="1")
    assert live.throughput(spark, query).agg(F.sum("input_rows")).first()[0] == 17
    rates = live.batch_rates(live.read_raw(spark, f"{path}/raw")[0]).orderBy("batch_id").collect()
    assert sorted(r.rows for r in rates) == [5, 12]
    assert rates[0].rows_per_second is None and rates[1].rows_per_second > 0


def test_totals_state_is_summed_before_the_shuffle(spark, make_tx, tmp_path):
    plan = live.running_totals(make_tx(*rows(0, 4)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 2


def test_snapshot(spark, make_tx, tmp_path):
    path = str(tmp_path)
    publish(make_tx(*rows(0, 40)), "parquet", path=f"{path}/topic")
    run_raw(spark, path)
    run_totals(spark, path)
    sums, _ = live.read_totals(spark, f"{path}/totals")
    raw, _ = live.read_raw(spark, f"{path}/raw")
    found = live_snapshot(sums, raw).first()
    assert found.has_data and found.total_transactions == 40
    assert found.total_revenue == pytest.approx(sum(i * 37 % 1000 for i in range(40)) / 100)
    revenue = [a.total_revenue for a in found.aggregates]
    assert revenue == sorted(revenue, reverse=True) and len(revenue) == 4
    assert found.aggregates[0].label == f"{found.aggregates[0].region} / {found.aggregates[0].category}"
    assert [r.transaction_id for r in found.recent] == list(range(39, 19, -1))


def test_snapshot_before_the_stream_has_run(spark, tmp_path):
    sums, summed = live.read_totals(spark, f"{tmp_path}/none")
    raw, arrived = live.read_raw(spark, f"{tmp_path}/none")
    found = live_snapshot(sums, raw, has_data=summed and arrived).first()
    assert tuple(found) == (False, [], [], 0, 0.0)


def test_live_tables_have_the_declared_columns():
    assert LIVE_RAW.fieldNames()[:12] == TRANSACTION.fieldNames()
    assert LIVE_TOTALS.fieldNames() == ["region", "category", "total_revenue", "total_units_sold", "updated_at", "batch_id"]


def test_live_session_has_few_state_partitions(spark, make_tx, tmp_path):
    path = str(tmp_path)
    publish(make_tx(*rows(0, 16)), "parquet", path=f"{path}/topic")
    session = live.live_session(spark, 2)
    assert spark.conf.get("spark.sql.shuffle.partitions") != "2"
    live.run_to_end(live.start_totals(
        live.file_stream(session, f"{path}/topic"), live.totals_files(f"{path}/totals"), f"{path}/c", name(),
    ))
    assert len(list((tmp_path / "c" / "state" / "0").glob("[0-9]*"))) == 2
    assert totals(spark, path) == expected(make_tx(*rows(0, 16)))


class Breaks:
    """A target that fails once in the middle of a batch, after part of the write."""

    def __init__(self, sink, batch_id):
        self.sink, self.batch_id = sink, batch_id

    def __call__(self, batch, batch_id):
        if batch_id == self.batch_id:
            self.batch_id = None
            self.sink(batch.limit(2), batch_id)
            raise RuntimeError("lost half way")
        self.sink(batch, batch_id)


@pytest.mark.parametrize("broken", [0, 1, 2])
def test_a_failed_batch_runs_again_without_doubling(spark, make_tx, tmp_path, broken):
    path = str(tmp_path)
    for i in range(3):
        publish(make_tx(*rows(i * 10, 10)).coalesce(1), "parquet", path=f"{path}/topic")
    stream = live.file_stream(spark, f"{path}/topic", maxFilesPerTrigger="1")
    raw = Breaks(live.raw_files(f"{path}/raw"), broken)
    sums = Breaks(live.totals_files(f"{path}/totals"), broken)

    def run():
        live.run_to_end(live.start_raw(stream, raw, f"{path}/c1", name()))

    def run_sums():
        live.run_to_end(live.start_totals(stream, sums, f"{path}/c2", name()))

    for once in (run, run_sums):
        with pytest.raises(Exception, match="lost half way"):
            once()
        once()
    found = live.read_raw(spark, f"{path}/raw")[0]
    assert sorted(r.transaction_id for r in found.collect()) == list(range(30))
    assert totals(spark, path) == expected(make_tx(*rows(0, 30)))


def test_a_reader_keeps_the_state_it_has(spark, make_tx, tmp_path):
    path = str(tmp_path)
    sink = live.totals_files(f"{path}/totals")
    state = group_totals(make_tx(*rows(0, 8)), "region", "category").withColumn("updated_at", F.current_timestamp())
    sink(state.limit(1), 0)
    held, found = live.read_totals(spark, f"{path}/totals")
    before = held.collect()
    for batch in range(1, 6):
        sink(state, batch)
    assert found and held.collect() == before
    assert live.read_totals(spark, f"{path}/totals")[0].count() == state.count()


def test_states_that_were_replaced_long_ago_are_deleted(spark, make_tx, tmp_path):
    path = f"{tmp_path}/totals"
    state = group_totals(make_tx(*rows(0, 4)), "region", "category").withColumn("updated_at", F.current_timestamp())
    for batch in range(4):
        live.totals_files(path, keep_hours=-1)(state, batch)
    assert [n for n, _ in live._states(spark, path)] == [2, 3]


def test_a_new_checkpoint_is_not_stale_and_loses_no_raw_row(spark, make_tx, tmp_path):
    path = str(tmp_path)
    for i in range(3):
        publish(make_tx(*rows(10 * i, 10)).coalesce(1), "parquet", path=f"{path}/topic")
    run_totals(spark, path, maxFilesPerTrigger="1")
    run_raw(spark, path, maxFilesPerTrigger="1")
    publish(make_tx(*rows(0, 4)), "parquet", path=f"{path}/new-topic")
    stream = live.file_stream(spark, f"{path}/new-topic")
    live.run_to_end(
        live.start_totals(stream, live.totals_files(f"{path}/totals"), f"{path}/new-totals", name()),
        live.start_raw(stream, live.raw_files(f"{path}/raw", run="second"), f"{path}/new-raw", name()))
    assert totals(spark, path) == expected(make_tx(*rows(0, 4)))
    assert live.read_raw(spark, f"{path}/raw")[0].count() == 34


@pytest.mark.parametrize("messages, parts, files", [(0, 4, 1), (40, 4, 1), (41, 4, 2), (10_000, 4, 250), (41, 1, 5)])
def test_files_of_a_topic_grow_with_its_messages(monkeypatch, messages, parts, files):
    monkeypatch.setattr(files_sink, "FILE_MESSAGES", 10)
    assert files_sink.files_per_part(messages, parts) == files


def order_tables(spark, folder, lines):
    """Order tables of so many lines, with one part, store and region."""
    def write(name, rows):
        spark.createDataFrame(rows, TABLES[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    day = dt.datetime(1996, 1, 1)
    write("region", [(1, "North")])
    write("nation", [(1, "N", 1)])
    write("supplier", [(1, "S", 1, 0.0)])
    write("part", [(1, "p", "b", "Toys", 1, 2.0)])
    write("lineitem", [(i, 1, 1, 1, 3.0, 6.0, 0.0, 0.0, "N", "O", day + dt.timedelta(i * 13)) for i in range(lines)])


class Written(Exception):
    """Ends a query once its topic has been handed over."""


@pytest.mark.parametrize("query", ["stream_totals", "null_id_totals", "stream_restart"])
def test_a_task_writes_a_bounded_part_of_a_topic(spark, tmp_path, monkeypatch, query):
    monkeypatch.setattr(files_sink, "FILE_MESSAGES", 10)
    order_tables(spark, tmp_path, 160)

    def publish_files(df, path):
        raise Written(df.rdd.getNumPartitions())
    monkeypatch.setattr(queries, "publish_files", publish_files)
    with pytest.raises(Written, match="^16$"):
        queries.QUERIES[query](spark, str(tmp_path))


def test_a_topic_of_many_files_comes_in_as_many_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files_sink, "FILE_MESSAGES", 10)
    order_tables(spark, tmp_path, 80)
    topic, share = queries._topic(spark, str(tmp_path))
    assert share == 2 and len(listed(spark, f"{topic}/*.parquet")) == queries.BATCHES * share


OVER_A_TOPIC = ["live_snapshot", "published_messages", "stream_raw_append", "stream_throughput", "stream_totals"]


@pytest.mark.parametrize("lines, files", [(40, 4), (41, 8), (400, 40)])
@pytest.mark.parametrize("query", OVER_A_TOPIC)
def test_tasks_that_write_a_topic_grow_in_number_with_it(spark, tmp_path, monkeypatch, query, lines, files):
    monkeypatch.setattr(files_sink, "FILE_MESSAGES", 10)
    order_tables(spark, tmp_path, lines)

    def publish_files(df, path):
        raise Written(df.rdd.getNumPartitions())
    monkeypatch.setattr(queries, "publish_files", publish_files)
    with pytest.raises(Written, match=f"^{files}$"):
        queries.QUERIES[query](spark, str(tmp_path))


@pytest.mark.parametrize("query", [q for q in OVER_A_TOPIC if q != "published_messages"])
def test_a_batch_takes_its_share_of_the_files_of_a_topic(spark, tmp_path, monkeypatch, query):
    monkeypatch.setattr(files_sink, "FILE_MESSAGES", 10)
    order_tables(spark, tmp_path, 400)

    def file_stream(session, path, **options):
        raise Written(options["maxFilesPerTrigger"])
    monkeypatch.setattr(queries, "publish_files", lambda df, path: None)
    monkeypatch.setattr(live, "file_stream", file_stream)
    with pytest.raises(Written, match="^10$"):
        queries.QUERIES[query](spark, str(tmp_path))
