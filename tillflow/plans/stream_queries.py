"""The registered queries of streams in event time, the ledger, progress and state."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions import codec
from tillflow.functions.money import from_cents, money_as_double
from tillflow.plans import reports, retail
from tillflow.schema import COORDINATED, LIVE_RAW, TRANSACTION
from tillflow.session import emptied, new_folder, stored
from tillflow.sinks.files import files_per_part
from tillflow.streaming import eventtime, ledger, live, progress

FILES = 4  # least files of one delivery; a live query takes one delivery in a batch
#: Deliveries end at these dates; rows held back come one delivery later.
ENDS = [dt.date(1997, 1, 1), dt.date(1999, 6, 1)]
LONG = 1200  # days: longer than any delivery takes
SHORT = 30


def _name(query: str) -> str:
    return f"{query}_{uuid.uuid4().hex[:8]}"


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every sale as a message with its place in the topic, its day as time and the delivery it
    comes with, numbered once."""
    body = F.to_json(F.struct(*TRANSACTION.fieldNames()), {"ignoreNullFields": "false"})
    numbered = retail.transactions(spark, folder).withColumn("offset", F.monotonically_increasing_id())
    day = F.col("date")
    delivery = F.when(day < F.lit(ENDS[0]), 0).when(day < F.lit(ENDS[1]), 1).otherwise(2)
    return stored(numbered.select(
        F.lit(None).cast("binary").alias("key"), body.cast("binary").alias("value"), F.lit("sales").alias("topic"),
        (F.col("offset") % 4).cast("int").alias("partition"), "offset",
        F.col("date").cast("timestamp").alias("timestamp"), "date", "transaction_id",
        delivery.alias("delivery")), "messages", by=("delivery",))


def _files(messages: DataFrame) -> int:
    """Files of each delivery, more of them for more messages."""
    return FILES * files_per_part(messages.count(), FILES * (len(ENDS) + 1))


def _deliver(messages: DataFrame, topic: str, files: int) -> None:
    # By a column, as rows dealt out in turn are sorted before, all columns of them.
    rows = messages.select(*COORDINATED.fieldNames()).repartition(files, "offset")
    rows.write.mode("append").parquet(topic)


def _pieces() -> list[Column]:
    """Which rows come with which delivery. Those without a date come last."""
    return [F.col("delivery") == k for k in range(len(ENDS) + 1)]


def _stream(spark: SparkSession, topic: str, files: int, partitions: int = live.STATE_PARTITIONS,
            large_state: bool = False) -> DataFrame:
    session = live.live_session(spark, partitions, large_state)
    return eventtime.coordinated_stream(session, topic, maxFilesPerTrigger=str(files))


def _spread(messages: DataFrame) -> int:
    """Partitions for a query that shuffles the messages themselves, or keeps an entry of each."""
    return max(live.STATE_PARTITIONS, files_per_part(messages.count()))


def _held() -> Column:
    return F.col("transaction_id") % 10 == 7


def stream_deduped(spark: SparkSession, folder: str) -> DataFrame:
    """The raw rows of a topic in which every third message was sent twice, once after others."""
    topic, path = new_folder(spark, "topic"), new_folder(spark, "live-raw")
    messages = _messages(spark, folder)
    files = _files(messages)
    for piece in _pieces():
        _deliver(messages.where(piece), topic, files)
        _deliver(messages.where(piece & (F.col("offset") % 3 == 0)), topic, files)
    once = eventtime.deduped(_stream(spark, topic, files, _spread(messages), large_state=True), f"{LONG} days")
    live.run_to_end(live.start_raw(
        once, live.raw_files(path), new_folder(spark, "raw-checkpoint"), _name("deduped")))
    emptied(spark, topic)
    return money_as_double(live.read_raw(spark, path)[0].select(*TRANSACTION.fieldNames()))


def _closing_mark(messages: DataFrame, days: int) -> DataFrame:
    """A message with nothing but a date so late that all days before it close."""
    last = messages.agg(F.date_add(F.max("date"), days).alias("date"))
    return last.select(
        F.lit(None).cast("binary").alias("key"), F.to_json(F.struct("date")).cast("binary").alias("value"),
        F.lit("sales").alias("topic"), F.lit(0).alias("partition"), F.lit(-1).cast("long").alias("offset"),
        F.col("date").cast("timestamp").alias("timestamp"), "date", F.lit(None).cast("long").alias("transaction_id"))


def stream_daily_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """The daily roll-up, each day given out when it closes. A tenth of the rows comes a delivery
    late, which the delay allows."""
    topic, path = new_folder(spark, "topic"), new_folder(spark, "days")
    messages = _messages(spark, folder)
    files = _files(messages)
    held = messages.where(F.lit(False))
    for piece in _pieces():
        _deliver(messages.where(piece & ~_held()).unionByName(held), topic, files)
        held = messages.where(piece & _held())
    _deliver(held, topic, files)
    _deliver(_closing_mark(messages, LONG + 2), topic, files)
    live.run_to_end(eventtime.start_days(
        codec.decode(_stream(spark, topic, files)), live.raw_files(path), new_folder(spark, "days-checkpoint"),
        f"{LONG} days", _name("days")))
    emptied(spark, topic)
    return money_as_double(spark.read.parquet(path).drop("closed_at", "run", "batch_id"))


def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose day had closed when they came: those of a tenth held back to the end."""
    topic, path = new_folder(spark, "topic"), new_folder(spark, "routed")
    messages = _messages(spark, folder)
    files = _files(messages)
    for piece in _pieces():
        _deliver(messages.where(piece & ~_held()), topic, files)
    _deliver(messages.where(_held()), topic, files)
    live.run_to_end(eventtime.start_routing(
        codec.decode(_stream(spark, topic, files)), path, new_folder(spark, "routing-checkpoint"),
        f"{SHORT} days", _name("routing")))
    emptied(spark, topic)
    late = eventtime.rows_of(spark, path, "late", LIVE_RAW)
    return money_as_double(late.select(*TRANSACTION.fieldNames()))


def stream_raw_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The raw rows after a run, a restart, and a query begun anew over the whole topic."""
    topic, path = new_folder(spark, "topic"), new_folder(spark, "ledger")
    first, second = (new_folder(spark, "ledger-checkpoint") for _ in range(2))
    messages = _messages(spark, folder)
    files = _files(messages)

    def run(checkpoint: str) -> None:
        live.run_to_end(ledger.start_ledger(
            _stream(spark, topic, files, _spread(messages)), path, checkpoint, _name("ledger")))
    pieces = _pieces()
    for piece, checkpoint in zip(pieces, (first, first, second), strict=True):
        _deliver(messages.where(piece), topic, files)
        run(checkpoint)
    emptied(spark, topic)
    return money_as_double(ledger.read_ledger(spark, path)[0].select(*TRANSACTION.fieldNames()))


def _totals_run(spark: SparkSession, folder: str) -> tuple[SparkSession, str, str, DataFrame]:
    """A totals query over three deliveries: its session, checkpoint, progress table."""
    topic, path, told = (new_folder(spark, n) for n in ("topic", "live-totals", "progress"))
    checkpoint = new_folder(spark, "totals-checkpoint")
    messages = _messages(spark, folder)
    files = _files(messages)
    for piece in _pieces():
        _deliver(messages.where(piece), topic, files)
    session = live.live_session(spark)
    table = progress.ProgressTable(session, told)
    try:
        query = live.start_totals(
            eventtime.coordinated_stream(session, topic, maxFilesPerTrigger=str(files)), live.totals_files(path),
            checkpoint, _name("running_totals"))
        live.run_to_end(query)
        table.wait(query)
    finally:
        table.close()
    emptied(spark, topic)
    return session, checkpoint, path, progress.read_progress(spark, told)


def stream_rates(spark: SparkSession, folder: str) -> DataFrame:
    """What every batch of a totals query reported: rows in all, and whether its rate is the rows
    over the seconds they took."""
    told = progress.agreeing(_totals_run(spark, folder)[3])
    return told.agg(
        F.sum("input_rows").alias("input_rows"), F.count_if(F.col("input_rows") > 0).alias("batches"),
        F.bool_and("agrees").alias("agree"))


def stream_state_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The totals as the query's state holds them after its last batch."""
    _, checkpoint, _, _ = _totals_run(spark, folder)
    state = progress.state_rows(spark, checkpoint, ("cents", "units"))
    return money_as_double(state.select(
        "region", "category", from_cents(F.col("cents")).alias("total_revenue"),
        F.col("units").alias("total_units_sold")))


#: What is read back of the live document.
LIVE_DOCUMENT = (
    "has_data boolean, batch_id long, agrees boolean, total_transactions long, total_revenue double, "
    "aggregates array<struct<label:string,total_revenue:double,total_units_sold:long>>, "
    "recent array<struct<transaction_id:long,date:string,store_id:string,product_id:string,sales_amount:double>>")


def live_document(spark: SparkSession, folder: str) -> DataFrame:
    """The live report as JSON, read back, while the raw query is a delivery ahead of the totals:
    it tells of the two deliveries that both have seen."""
    topic, raw_path, totals_path = (new_folder(spark, n) for n in ("topic", "live-raw", "live-totals"))
    raw_place, totals_place = (new_folder(spark, n) for n in ("raw-checkpoint", "totals-checkpoint"))
    messages = _messages(spark, folder)
    files = _files(messages)

    def raw_query():
        return live.start_raw(_stream(spark, topic, files), live.raw_files(raw_path), raw_place, _name("raw_records"))

    def totals_query():
        return live.start_totals(
            _stream(spark, topic, files), live.totals_files(totals_path), totals_place, _name("running_totals"))
    first, second, third = _pieces()
    for piece, started in ((first, (raw_query, totals_query)), (second, (raw_query, totals_query)),
                           (third, (raw_query,))):
        _deliver(messages.where(piece), topic, files)
        live.run_to_end(*[start() for start in started])
    emptied(spark, topic)
    document = reports.live_document(*live.read_shared(spark, totals_path, raw_path))
    told = document.select(F.from_json("document", LIVE_DOCUMENT).alias("d")).select("d.*")

    def cents(value: Column) -> Column:
        return F.round(value * 100).cast("long").cast("string")

    def listed(name: str, line) -> Column:
        return F.concat_ws(";", F.transform(name, lambda r: F.concat_ws("|", *line(r)))).alias(name)
    return told.select(
        "has_data", "batch_id", "agrees", "total_transactions", "total_revenue",
        listed("aggregates", lambda r: (
            r["label"], cents(r["total_revenue"]), r["total_units_sold"].cast("string"))),
        listed("recent", lambda r: (
            r["transaction_id"].cast("string"), r["date"], r["store_id"], r["product_id"], cents(r["sales_amount"]))))


QUERIES = {
    query.__name__: query
    for query in (
        stream_deduped, stream_daily_revenue, stream_late_rows, stream_raw_ledger, stream_rates, stream_state_rows,
        live_document,
    )
}
