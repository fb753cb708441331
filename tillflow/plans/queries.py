"""The registered queries: every operator over the whole given tables.

A query takes the session and the folder of the tables and returns a DataFrame.
Money leaves as doubles, so that the results compare with engines whose decimals
are typed differently.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillflow.functions import calendar, codec, money, text
from tillflow.functions.money import money_as_double
from tillflow.operators import evaluate, features, model, paging, split, totals
from tillflow.operators.keys import surrogate_key as number_rows
from tillflow.plans import forecast, reports, retail
from tillflow.plans.stream_queries import QUERIES as STREAM_QUERIES
from tillflow.schema import LABEL, MESSAGE, PREDICTION, TRANSACTION
from tillflow.session import emptied, new_folder, stored
from tillflow.sinks.files import append_rows, files_per_part, publish_files, write_csv
from tillflow.sinks.published import publish_table, read_published
from tillflow.sources.files import bounded, date_spine_of, first_rows, read_csv, table
from tillflow.streaming import live

Query = Callable[[SparkSession, str], DataFrame]


# --- transactions ------------------------------------------------------------

def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return money_as_double(retail.transactions(spark, folder))


def factors(spark: SparkSession, folder: str) -> DataFrame:
    """Weekday and season factors of every sale line, and its units scaled by them
    and by the least boost of a promotion (1.3)."""
    lines = retail.with_promotion(retail.sale_lines(spark, folder))
    boost = F.when(F.col("promotion_flag") == 1, F.lit(1.3)).otherwise(F.lit(1.0))
    return lines.select(
        "transaction_id", "date", "units_sold",
        calendar.weekday_factor(F.col("date")).alias("weekday_factor"),
        calendar.season_factor(F.col("date")).alias("season_factor"),
        boost.alias("promo_boost"),
    ).withColumn("adjusted_units", money.adjusted_units(
        F.col("units_sold"), F.col("weekday_factor"), F.col("season_factor"), F.col("promo_boost")
    ))


def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    return number_rows(parts, "p_partkey", name="row_id")


def numbered_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return number_rows(lines, *lines.columns, copies=True)


# --- the daily series --------------------------------------------------------

def daily_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return money_as_double(retail.daily_revenue(spark, folder))


def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    dates = table(spark, folder, "orders").select(
        F.col("o_orderkey"), F.col("o_orderdate").cast("date").alias("date")
    )
    return features.with_calendar(dates)


def lag_rolling(spark: SparkSession, folder: str) -> DataFrame:
    return money_as_double(features.with_history(retail.daily_revenue(spark, folder)).select(
        "date", LABEL, "prev_day_revenue", "rolling_7day_avg_revenue"
    ))


def rolling_calendar_days(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue of the seven calendar days before each day: the series has gaps."""
    daily = retail.daily_revenue(spark, folder)
    return money_as_double(features.with_calendar_frame(daily).select(
        "date", LABEL, "days_sold", "window_revenue", "mean_of_days_sold", "mean_of_days"))


def daily_features(spark: SparkSession, folder: str) -> DataFrame:
    return money_as_double(features.daily_features(retail.daily_revenue(spark, folder)))


def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    daily = features.daily_features(retail.daily_revenue(spark, folder))
    return split.holdout(daily).select("date", "idx", "part")


def date_spine(spark: SparkSession, folder: str) -> DataFrame:
    return date_spine_of(table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date")
    ))


def gap_filled_daily(spark: SparkSession, folder: str) -> DataFrame:
    daily = stored(retail.daily_revenue(spark, folder), "daily")
    return money_as_double(features.fill_missing_days(daily, date_spine_of(daily)))


# --- predictions and reports -------------------------------------------------

def baseline_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.baseline_predictions(retail.daily_revenue(spark, folder))


def forecast_errors(spark: SparkSession, folder: str) -> DataFrame:
    rows = evaluate.with_errors(baseline_predictions(spark, folder))
    return rows.withColumn("tags", F.concat_ws(", ", "tags"))


def eval_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.metrics(baseline_predictions(spark, folder))


def overview(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.overview(baseline_predictions(spark, folder))


def _page(spark: SparkSession, folder: str, wanted: object) -> DataFrame:
    predictions = stored(baseline_predictions(spark, folder), "predictions")
    page = reports.prediction_page(predictions, wanted)
    return page.withColumn("tags", F.concat_ws(", ", "tags"))


def predictions_page_1(spark: SparkSession, folder: str) -> DataFrame:
    return _page(spark, folder, 1)


def predictions_page_last(spark: SparkSession, folder: str) -> DataFrame:
    return _page(spark, folder, 10**9)


def page_info(spark: SparkSession, folder: str) -> DataFrame:
    return paging.page_info(baseline_predictions(spark, folder))


def weekday_profile(spark: SparkSession, folder: str) -> DataFrame:
    return reports.weekday_profile(baseline_predictions(spark, folder))


def error_series(spark: SparkSession, folder: str) -> DataFrame:
    return reports.error_series(baseline_predictions(spark, folder))


def scatter_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return reports.scatter_bounds(baseline_predictions(spark, folder))


def chart_series(spark: SparkSession, folder: str) -> DataFrame:
    """The lists behind the charts, each as one text."""
    lists = reports.chart_series(baseline_predictions(spark, folder))

    def cents(name: str) -> Column:
        return F.transform(name, lambda x: x.cast("decimal(28,2)").cast("string"))

    def whole(name: str) -> Column:
        """Whole cents, cut off: the doubles themselves print differently in other engines."""
        return F.transform(name, lambda x: F.floor(x * 100).cast("string"))

    return lists.select(
        "has_data", F.concat_ws(",", "dates").alias("dates"),
        F.concat_ws(",", cents("actual")).alias("actual"),
        F.concat_ws(",", cents("scatter.x")).alias("scatter_x"),
        F.concat_ws(",", whole("predicted")).alias("predicted"),
        F.concat_ws(",", whole("scatter.y")).alias("scatter_y"),
        F.concat_ws(",", F.transform("errors", lambda x: F.round(x * 100).cast("long").cast("string"))).alias("errors"),
    )


def report_json(spark: SparkSession, folder: str) -> DataFrame:
    predictions = stored(baseline_predictions(spark, folder), "predictions")
    return reports.chart_document(predictions)


# --- totals and latest rows --------------------------------------------------

def region_category_totals(spark: SparkSession, folder: str) -> DataFrame:
    return money_as_double(retail.region_category_totals(spark, folder))


def top15_groups(spark: SparkSession, folder: str) -> DataFrame:
    top = totals.top_groups(retail.region_category_totals(spark, folder))
    label = text.group_label(F.col("region"), F.col("category"))
    return money_as_double(top.withColumn("label", label))


def totals_text(spark: SparkSession, folder: str) -> DataFrame:
    """The totals as a report prints them."""
    return retail.region_category_totals(spark, folder).select(
        text.group_label(F.col("region"), F.col("category")).alias("label"),
        text.figure(F.col("total_revenue"), 2).alias("revenue"),
        text.figure(F.col("total_units_sold"), 0).alias("units"),
    )


def live_totals(spark: SparkSession, folder: str) -> DataFrame:
    revenue = totals.live_totals(retail.region_category_totals(spark, folder))
    lines = table(spark, folder, "lineitem").agg(F.count("*")).scalar()
    return revenue.withColumn("total_transactions", lines)


def recent_events_20(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return totals.latest(events, "ts", "event_id", 20)


# --- text formats ------------------------------------------------------------

def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return money_as_double(codec.decode(codec.encode(retail.transactions(spark, folder))))


def _event_messages(spark: SparkSession, folder: str) -> DataFrame:
    """A message per event, readable or not by its type: a whole transaction, a
    field of a wrong type, only unknown fields, no JSON, nothing at all."""
    transaction = {
        "transaction_id": F.col("event_id"),
        "date": F.col("ts").cast("date"),
        "unit_price": F.col("value").cast("decimal(18,2)"),
    }
    good = F.struct(*[c.alias(n) for n, c in transaction.items()])
    wrong = F.struct(*[
        c.alias(n) for n, c in {**transaction, "units_sold": F.col("event_type")}.items()
    ])
    body = (
        F.when(F.col("event_type") == "purchase", F.to_json(good))
        .when(F.col("event_type") == "click", F.to_json(wrong))
        .when(F.col("event_type") == "view", F.col("props"))
        .when(F.col("event_type") == "error", F.concat(F.lit("not json "), F.col("props")))
    )
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
    )


def json_good_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = codec.decode(_event_messages(spark, folder))
    return money_as_double(rows.select("transaction_id", "date", "unit_price"))


def json_dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    return codec.dead_letters(_event_messages(spark, folder)).select(
        F.col("key").cast("string").cast("long").alias("event_id"),
        F.col("value").cast("string").alias("message"),
    )


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "csv")
    write_csv(retail.transactions(spark, folder), path)
    return money_as_double(read_csv(spark, path, TRANSACTION))


def appended_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The orders, written as finished ones first and the others appended."""
    path = new_folder(spark, "orders")
    orders = table(spark, folder, "orders")
    finished = F.col("o_orderstatus") == "F"
    append_rows(orders.where(finished), path)
    append_rows(orders.where(~finished | finished.isNull()), path)
    return spark.read.schema(orders.schema).parquet(path)


def bounded_scan(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    return bounded(events, 1000, [F.col("event_id")])


def bounded_scan_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the lines, whichever come first: how many they are, and whether each is a line of
    the table and none came twice."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, folder, "lineitem").select(*keys)
    taken = first_rows(lines, lines.count() // 2)
    most = lines.groupBy(*keys).agg(F.count("*").alias("there"))
    seen = taken.groupBy(*keys).agg(F.count("*").alias("rows")).join(most, keys, "left")
    return seen.agg(F.sum("rows").alias("rows"), F.bool_and(F.col("rows") <= F.coalesce("there", F.lit(0))).alias("whole"))


# --- the live path -----------------------------------------------------------

BATCHES = 4  # batches of a topic; the files of each grow in number with the table


def _share(spark: SparkSession, folder: str, name: str = "lineitem", batches: int = BATCHES) -> int:
    """Files of a batch, if the rows of a table come as messages in so many batches. The rows
    are counted by the footers of its files."""
    return files_per_part(table(spark, folder, name).count(), batches)


def _topic(spark: SparkSession, folder: str) -> tuple[str, int]:
    """The transactions, published as messages to files that a live query takes in a few
    batches, so that it carries its state over them; and the files of a batch."""
    path, share = new_folder(spark, "topic"), _share(spark, folder)
    publish_files(retail.transactions(spark, folder).repartition(BATCHES * share), path)
    return path, share


def _stream(spark: SparkSession, topic: str, share: int) -> DataFrame:
    return live.file_stream(live.live_session(spark), topic, maxFilesPerTrigger=str(share))


def _name(query: str) -> str:
    return f"{query}_{uuid.uuid4().hex[:8]}"


def _start_totals(spark: SparkSession, topic: str, share: int) -> tuple[str, StreamingQuery]:
    path = new_folder(spark, "live-totals")
    return path, live.start_totals(
        _stream(spark, topic, share), live.totals_files(path),
        new_folder(spark, "totals-checkpoint"), _name("running_totals"),
    )


def _start_raw(spark: SparkSession, topic: str, share: int) -> tuple[str, StreamingQuery]:
    path = new_folder(spark, "live-raw")
    return path, live.start_raw(
        _stream(spark, topic, share), live.raw_files(path, run=uuid.uuid4().hex),
        new_folder(spark, "raw-checkpoint"), _name("raw_records"),
    )


def _raw_table(spark: SparkSession, folder: str) -> DataFrame:
    topic, share = _topic(spark, folder)
    path, query = _start_raw(spark, topic, share)
    live.run_to_end(query)
    emptied(spark, topic)
    return live.read_raw(spark, path)[0]


def published_messages(spark: SparkSession, folder: str) -> DataFrame:
    messages = spark.read.schema(MESSAGE).parquet(_topic(spark, folder)[0])
    return messages.select(F.col("value").cast("string").alias("message"))


def stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    topic, share = _topic(spark, folder)
    path, query = _start_totals(spark, topic, share)
    live.run_to_end(query)
    emptied(spark, topic)
    rows, _ = live.read_totals(spark, path)
    return money_as_double(rows.select(
        "region", "category", "total_revenue", "total_units_sold"
    ))


def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of a query that ran over the first messages, ended, and went on from its
    checkpoint when the others had come."""
    topic, path, place = (new_folder(spark, n) for n in ("topic", "live-totals", "totals-checkpoint"))
    sales = retail.transactions(spark, folder)
    late = F.col("transaction_id") % 3 == 0
    share = _share(spark, folder, batches=2)
    for part in (sales.where(~late), sales.where(late)):
        publish_files(part.repartition(2 * share), topic)
        live.run_to_end(live.start_totals(
            _stream(spark, topic, share), live.totals_files(path), place, _name("running_totals")))
    emptied(spark, topic)
    return money_as_double(live.read_totals(spark, path)[0].select(
        "region", "category", "total_revenue", "total_units_sold"))


def null_id_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of a stream in which every tenth sale has lost its id: no revenue goes with it."""
    topic, path = new_folder(spark, "topic"), new_folder(spark, "live-totals")
    sales = retail.transactions(spark, folder)
    some = F.when(F.col("transaction_id") % 10 != 0, F.col("transaction_id"))
    share = _share(spark, folder)
    publish_files(sales.withColumn("transaction_id", some).repartition(BATCHES * share), topic)
    live.run_to_end(live.start_totals(
        _stream(spark, topic, share), live.totals_files(path), new_folder(spark, "totals-checkpoint"),
        _name("running_totals")))
    emptied(spark, topic)
    return money_as_double(live.read_totals(spark, path)[0].select(
        "region", "category", "total_revenue", "total_units_sold"))


def stream_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """What the live queries leave out of the event messages, kept by the third query."""
    topic, path = new_folder(spark, "topic"), new_folder(spark, "rejects")
    share = _share(spark, folder, "events")
    _event_messages(spark, folder).repartition(BATCHES * share).write.parquet(topic)
    live.run_to_end(live.start_rejects(
        _stream(spark, topic, share), live.raw_files(path), new_folder(spark, "rejects-checkpoint"), _name("rejects")))
    emptied(spark, topic)
    kept = spark.read.parquet(path)
    return kept.where(F.col("received_at").isNotNull()).select(
        F.col("key").cast("string").cast("long").alias("event_id"), F.col("value").cast("string").alias("message"))


def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a CSV whose date or amount is no such thing, kept as their text."""
    path = new_folder(spark, "bad-csv")
    events = table(spark, folder, "events")
    day = F.col("ts").cast("date").cast("string")
    lines = events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), day)).otherwise(day).alias("date"),
        F.when(F.col("event_type") == "view", F.lit("much")).otherwise(F.lit("1.50")).alias("sales_amount"))
    write_csv(lines, path)
    schema = T.StructType([TRANSACTION[n] for n in ("transaction_id", "date", "sales_amount")])
    # A query of the line alone would not parse the fields, and find no bad one.
    rows = stored(read_csv(spark, path, schema, bad_column="line"), "csv-lines")
    return rows.where("line is not null").select("line")


def stream_raw_append(spark: SparkSession, folder: str) -> DataFrame:
    return money_as_double(_raw_table(spark, folder).select(*TRANSACTION.fieldNames()))


def stream_throughput(spark: SparkSession, folder: str) -> DataFrame:
    """Rows the raw query took in; the rates beside them differ from run to run."""
    rates = live.batch_rates(_raw_table(spark, folder))
    return rates.agg(F.sum("rows").alias("input_rows"))


def live_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Both live queries side by side, then the live report over their tables."""
    topic, share = _topic(spark, folder)
    totals_path, summing = _start_totals(spark, topic, share)
    raw_path, appending = _start_raw(spark, topic, share)
    live.run_to_end(summing, appending)
    emptied(spark, topic)
    sums, summed = live.read_totals(spark, totals_path)
    raw, arrived = live.read_raw(spark, raw_path)
    report = reports.live_snapshot(sums, raw, has_data=summed and arrived)
    return report.select(
        "has_data", "total_transactions", "total_revenue",
        F.size("recent").alias("recent_rows"),
        F.concat_ws("; ", F.col("aggregates.label")).alias("top_labels"),
    )


# --- the model ---------------------------------------------------------------

def _forest(spark: SparkSession, folder: str):
    return forecast.train_and_predict(retail.daily_revenue(spark, folder))


def rf_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _forest(spark, folder)[1]


def rf_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.metrics(_forest(spark, folder)[1])


def rf_importances(spark: SparkSession, folder: str) -> DataFrame:
    forest, predictions = _forest(spark, folder)
    return model.importances(forest, predictions)


def _published_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The prediction table as reports find it: the forest's, published after the baseline's."""
    path = new_folder(spark, "published")
    daily = stored(retail.daily_revenue(spark, folder), "daily")
    publish_table(forecast.baseline_predictions(daily), path)
    publish_table(forecast.train_and_predict(daily)[1], path)
    return read_published(spark, path, PREDICTION)[0]


def predictions_of_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The published table: its days and actuals, and whether each prediction lies within the
    revenues that the forest was trained on, as a mean of them must."""
    rows = _published_forest(spark, folder)
    trained = split.train_part(split.holdout(features.daily_features(retail.daily_revenue(spark, folder))))
    ends = trained.agg(F.min(LABEL).cast("double").alias("low"), F.max(LABEL).cast("double").alias("high"))
    slack = 1e-9  # a mean of doubles may round beyond them
    return rows.join(F.broadcast(ends)).select(  # one row of ends
        "date", "actual_revenue", "day_of_week_num", "is_weekend", "is_holiday_season",
        F.col("predicted_revenue").between(
            F.col("low") * (1 - slack), F.col("high") * (1 + slack)).alias("within_trained"))


def overview_of_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The overview over the published table, and whether its metrics are those of MLlib."""
    rows = _published_forest(spark, folder)
    ours = evaluate.metrics(rows)
    same = F.lit(True)
    for name in ("rmse", "mae", "r2"):
        theirs = F.lit(model.evaluator(name).evaluate(rows))
        same = same & (F.abs(F.col(name) - theirs) <= F.abs(theirs) * 1e-9)
    return evaluate.overview(rows).select(
        "has_data", "days", "first_date", "last_date", "total_actual", "avg_actual",
        (F.col("mape") >= 0).alias("has_mape"), ours.select(same).scalar().alias("as_by_mllib"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        transactions, factors, surrogate_key, numbered_lines,
        daily_revenue, calendar_features, lag_rolling, rolling_calendar_days, daily_features, holdout_split,
        date_spine, gap_filled_daily,
        baseline_predictions, forecast_errors, eval_metrics, overview,
        predictions_page_1, predictions_page_last, page_info,
        weekday_profile, error_series, scatter_bounds, chart_series, report_json,
        region_category_totals, top15_groups, totals_text, live_totals, recent_events_20,
        json_roundtrip, json_good_rows, json_dead_letter,
        csv_roundtrip, appended_orders, bounded_scan, bounded_scan_spread,
        csv_rejects, null_id_totals, stream_dead_letters, stream_restart,
        published_messages, stream_totals, stream_raw_append, stream_throughput, live_snapshot,
        rf_predictions, rf_metrics, rf_importances, predictions_of_forest, overview_of_forest,
    )
}
QUERIES |= STREAM_QUERIES
