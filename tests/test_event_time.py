"""Replays, closing days, late rows, the ledger, progress and state."""

import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.functions import codec
from tillflow.operators.totals import daily_rollup
from tillflow.plans import stream_queries
from tillflow.schema import COORDINATED, LIVE_RAW, TRANSACTION
from tillflow.sinks import files as files_sink
from tillflow.streaming import eventtime, ledger, live, progress
from tillflow.streaming.files import checkpoint_id, created, exists, listed

FIRST = dt.date(2024, 1, 1)


def name():
    return f"q{uuid.uuid4().hex}"


def sales(days):
    """A sale for each day number; its id is its place in the list."""
    return [dict(transaction_id=i, date=None if d is None else FIRST + dt.timedelta(d), units_sold=i % 3 + 1,
                 sales_amount=Decimal(i * 37 % 1000) / 100) for i, d in enumerate(days)]


def messages(tx, first=0):
    """The sales as messages of one partition, from an offset on."""
    body = F.to_json(F.struct(*TRANSACTION.fieldNames()))
    return tx.select(
        F.lit(None).cast("binary").alias("key"), body.cast("binary").alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), (F.col("transaction_id") + first).alias("offset"),
        F.col("date").cast("timestamp").alias("timestamp")).select(*COORDINATED.fieldNames())


def deliver(tx, topic, first=0):
    messages(tx, first).coalesce(1).write.mode("append").parquet(topic)


def make_lines(spark, folder, n):
    """The tables that transactions are made from, with ``n`` sale lines over seven years, some undated."""
    lines = spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 5).alias("l_partkey"), (F.col("id") % 3).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit(10.0).alias("l_extendedprice"),
        F.lit(0.05).alias("l_discount"), F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), F.when(F.col("id") % 50 != 7, F.expr(
            "timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, cast(id * 2500 / %d as int))" % n)).alias("l_shipdate"))
    tables = {
        "lineitem": lines,
        "part": spark.sql("select id as p_partkey, 'n' as p_name, 'b' as p_brand, 'kind' as p_type, 1 as p_size, "
                          "cast(9.5 as double) as p_retailprice from range(5)"),
        "supplier": spark.sql("select id as s_suppkey, 's' as s_name, 0 as s_nationkey, "
                              "cast(0 as double) as s_acctbal from range(3)"),
        "nation": spark.sql("select 0 as n_nationkey, 'n' as n_name, 0 as n_regionkey"),
        "region": spark.sql("select 0 as r_regionkey, 'r' as r_name"),
    }
    for table, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    return lines


def stream(spark, topic):
    return eventtime.coordinated_stream(spark, topic, maxFilesPerTrigger="1")


def ids(df):
    return sorted(r.transaction_id for r in df.select("transaction_id").collect())


def test_replays_are_dropped_and_the_state_stays_small(spark, make_tx, tmp_path):
    path = str(tmp_path)
    for day in range(0, 60, 5):
        part = make_tx(*sales([day] * 10))
        deliver(part, f"{path}/topic", day * 100)
        deliver(part, f"{path}/topic", day * 100)  # the same coordinates again
    query = live.start_raw(
        eventtime.deduped(stream(spark, f"{path}/topic"), "6 days"), live.raw_files(f"{path}/raw"), f"{path}/c", name(),
        carry=("offset",))
    live.run_to_end(query)
    offsets = [r.offset for r in spark.read.parquet(f"{path}/raw").select("offset").collect()]
    assert sorted(offsets) == sorted(day * 100 + i for day in range(0, 60, 5) for i in range(10))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 40


def test_state_of_every_message_lies_on_disk(spark, make_tx, tmp_path, monkeypatch):
    """Held in the heap it takes some 400 bytes a message, and would end the executors."""
    path, ended, wait = str(tmp_path), [], live.run_to_end
    monkeypatch.setattr(live, "run_to_end", lambda *queries: (wait(*queries), ended.extend(queries)))
    lines = make_lines(spark, f"{path}/tables", 300)
    found = stream_queries.stream_deduped(spark, f"{path}/tables")
    dated = lines.where("l_shipdate is not null")  # a replay is known by the time of its message
    assert ids(found.where("date is not null")) == sorted(r.l_orderkey for r in dated.collect())
    assert set(ids(found)) == set(range(300))
    told = [p["stateOperators"][0]["customMetrics"] for p in ended[0].recentProgress if p["stateOperators"]]
    assert told and all("rocksdbCommitFlushLatency" in metrics for metrics in told)


def test_a_delivery_reads_its_own_messages_only(spark, tmp_path):
    make_lines(spark, str(tmp_path), 300)
    messages = stream_queries._messages(spark, str(tmp_path))
    files = [{r[0] for r in messages.where(piece).select(F.input_file_name()).distinct().collect()}
             for piece in stream_queries._pieces()]
    assert all(files) and sum(map(len, files)) == len(set.union(*files))
    days = [messages.where(piece).agg(F.min("date"), F.max("date")).first() for piece in stream_queries._pieces()]
    first, second = stream_queries.ENDS
    assert days[0][1] < first <= days[1][0] <= days[1][1] < second <= days[2][0]
    assert messages.where("date is null").select("delivery").distinct().collect() == [(2,)]


def test_days_are_given_out_once_when_they_close(spark, make_tx, tmp_path):
    path = str(tmp_path)
    deliveries = [sales([0, 0, 1, 2]), sales([1, 3, 4]), sales([40])]
    for k, rows in enumerate(deliveries):
        deliver(make_tx(*rows), f"{path}/topic", 100 * k)
    live.run_to_end(eventtime.start_days(
        codec.decode(stream(spark, f"{path}/topic")), live.raw_files(f"{path}/days"), f"{path}/c", "10 days", name()))
    found = spark.read.parquet(f"{path}/days").drop("closed_at", "run", "batch_id")
    wanted = daily_rollup(make_tx(*[r for rows in deliveries[:2] for r in rows]))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def routed(spark, path, delay):
    live.run_to_end(eventtime.start_routing(
        codec.decode(stream(spark, f"{path}/topic")), f"{path}/routed", f"{path}/routing", delay, name()))
    return {side: eventtime.rows_of(spark, f"{path}/routed", side, LIVE_RAW) for side in ("in_time", "late", "undated")}


def test_late_and_undated_rows_are_kept_beside(spark, make_tx, tmp_path):
    path = str(tmp_path)
    every = []
    for k, days in enumerate([[0, 1, 20], [9, 10, 5, 21], [None, 11, 10, 60], [21, 54, 55]]):
        rows = [{**r, "transaction_id": r["transaction_id"] + 100 * k} for r in sales(days)]
        every += rows
        deliver(make_tx(*rows), f"{path}/topic")
    sides = routed(spark, path, "10 days")
    # 10 days before day 20 is day 10: day 9 has closed, day 10 has not. Later 21 - 10 = 11.
    assert ids(sides["late"]) == [100, 102, 202, 300] and ids(sides["undated"]) == [200]
    assert sorted(ids(sides["in_time"]) + [100, 102, 202, 300, 200]) == sorted(r["transaction_id"] for r in every)
    # The windowed query over the rows in time drops none of them.
    schema = sides["in_time"].drop("batch_id").schema
    timely = eventtime.in_time_stream(spark, f"{path}/routed", schema, maxFilesPerTrigger="1")
    query = eventtime.start_days(timely, live.raw_files(f"{path}/days"), f"{path}/days-c", "10 days", name())
    live.run_to_end(query)
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) == 0


def test_routing_goes_on_after_a_restart(spark, make_tx, tmp_path):
    path = str(tmp_path)
    deliver(make_tx(*sales([0, 50])), f"{path}/topic")
    routed(spark, path, "10 days")
    deliver(make_tx(*sales([39, 40])), f"{path}/topic", 10)
    sides = routed(spark, path, "10 days")
    assert ids(sides["late"]) == [0] and ids(sides["in_time"]) == [0, 1, 1]
    batch = make_tx(*sales([39, 40])).withColumn("received_at", F.current_timestamp())
    eventtime.routed_files(f"{path}/routed", "10 days")(batch, 1)  # once more, as after a crash
    assert eventtime.rows_of(spark, f"{path}/routed", "in_time", LIVE_RAW).count() == 3


# --- the ledger ----------------------------------------------------------------

def run_ledger(spark, path, checkpoint, sink=None):
    live.run_to_end(live.start_raw(
        stream(spark, f"{path}/topic"), sink or ledger.ledger_files(f"{path}/ledger", f"{path}/{checkpoint}"),
        f"{path}/{checkpoint}", name(), carry=live.COORDINATES))


def ledger_ids(spark, path):
    return ids(ledger.read_ledger(spark, f"{path}/ledger")[0])


def test_restart_and_new_checkpoint_keep_each_row_once(spark, make_tx, tmp_path):
    path = str(tmp_path)
    assert ledger.read_ledger(spark, f"{path}/ledger")[0].collect() == []
    tx = make_tx(*sales(range(30)))
    deliver(tx.where("transaction_id < 10"), f"{path}/topic")
    run_ledger(spark, path, "a")
    deliver(tx.where("transaction_id between 10 and 19"), f"{path}/topic")
    run_ledger(spark, path, "a")
    assert ledger_ids(spark, path) == list(range(20))
    run_ledger(spark, path, "b")  # begun anew, nothing new
    assert ledger_ids(spark, path) == list(range(20))
    deliver(tx.where("transaction_id >= 20"), f"{path}/topic")
    run_ledger(spark, path, "b")
    run_ledger(spark, path, "a")
    assert ledger_ids(spark, path) == list(range(30))
    owners = {r.owner for r in ledger.entries(spark, f"{path}/ledger").collect()}
    assert owners == {checkpoint_id(spark, f"{path}/{c}") for c in "ab"}


def test_messages_read_anew_are_not_parsed_again(spark, make_tx, tmp_path, monkeypatch):
    path, parsed = str(tmp_path), []
    monkeypatch.setattr(ledger, "decode", lambda rows, *more: parsed.append(rows.count()) or codec.decode(rows, *more))

    def run(checkpoint):
        live.run_to_end(ledger.start_ledger(
            stream(spark, f"{path}/topic"), f"{path}/ledger", f"{path}/{checkpoint}", name()))
    tx = make_tx(*sales(range(30)))
    for rows, checkpoint, new in (("id < 10", "a", [10]), ("id between 10 and 19", "a", [10]), ("id >= 20", "b", [0, 0, 10])):
        deliver(tx.where(rows.replace("id", "transaction_id")), f"{path}/topic")
        run(checkpoint)
        assert [parsed.pop(0) for _ in new] == new and not parsed
    assert ledger_ids(spark, path) == list(range(30))


def test_deliveries_and_state_are_spread_for_more_messages(spark, monkeypatch):
    monkeypatch.setattr(files_sink, "FILE_MESSAGES", 10)
    for n, files, partitions in ((5, 4, 8), (120, 4, 12), (1200, 40, 120)):
        messages = spark.range(n)
        assert (stream_queries._files(messages), stream_queries._spread(messages)) == (files, partitions)


@pytest.mark.parametrize("wrote_entry", [False, True])
def test_a_batch_that_failed_is_not_seen_twice(spark, make_tx, tmp_path, wrote_entry):
    path = str(tmp_path)
    deliver(make_tx(*sales(range(10))), f"{path}/topic")
    deliver(make_tx(*sales(range(10))).withColumn("transaction_id", F.col("transaction_id") + 10), f"{path}/topic")
    real = ledger.ledger_files(f"{path}/ledger", f"{path}/c")
    broken = []

    def sink(batch, batch_id):
        if batch_id == 1 and not broken:
            broken.append(batch_id)
            if wrote_entry:
                real(batch, batch_id)
            else:  # rows written, but not entered
                batch.withColumn("batch_id", F.lit(1)).write.parquet(f"{path}/ledger/data/left-over")
            raise RuntimeError("lost half way")
        real(batch, batch_id)

    with pytest.raises(Exception, match="lost half way"):
        run_ledger(spark, path, "c", sink)
    run_ledger(spark, path, "c", sink)
    assert ledger_ids(spark, path) == list(range(20))
    assert len(listed(spark, f"{path}/ledger/manifest/*.json")) == 2


def test_an_entry_is_made_once(spark, tmp_path):
    path = f"{tmp_path}/x/entry"
    assert not exists(spark, path)
    assert created(spark, path, "one") and not created(spark, path, "two")
    assert spark.read.text(path).first()[0] == "one"


# --- progress and state ----------------------------------------------------------

def test_every_batch_is_in_the_progress_table(spark, make_tx, tmp_path):
    path = str(tmp_path)
    for k in range(3):
        deliver(make_tx(*sales(range(k + 1))), f"{path}/topic", 10 * k)
    table = progress.ProgressTable(spark, f"{path}/progress")
    try:
        query = live.start_totals(stream(spark, f"{path}/topic"), live.totals_files(f"{path}/totals"), f"{path}/c", name())
        live.run_to_end(query)
        table.wait(query)
    finally:
        table.close()
    told = progress.agreeing(progress.read_progress(spark, f"{path}/progress")).where("input_rows > 0")
    assert sorted((r.batch_id, r.input_rows, r.agrees) for r in told.collect()) == [(0, 1, True), (1, 2, True), (2, 3, True)]
    assert {r.query for r in told.collect()} == {str(query.id)}
    state = progress.state_rows(spark, f"{path}/c", ("cents", "units")).collect()
    totals = live.read_totals(spark, f"{path}/totals")[0].collect()
    assert [(r.region, r.category, r.cents, r.units) for r in state] == [
        (r.region, r.category, int(r.total_revenue * 100), r.total_units_sold) for r in totals]
    assert progress.read_progress(spark, f"{path}/none").collect() == []
