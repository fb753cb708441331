"""The three jobs of the pipeline, end to end.

Paths are any URI that Spark can read; the formats and options of a topic and of
the targets are the caller's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators import evaluate, model
from tillflow.operators.split import TEST_DAYS
from tillflow.operators.totals import daily_rollup
from tillflow.plans.forecast import train_and_predict
from tillflow.schema import FEATURES, PREDICTION
from tillflow.session import stored
from tillflow.sinks.files import publish
from tillflow.sinks.published import publish_table, read_published
from tillflow.sources.files import dated, first_rows, read_csv
from tillflow.streaming import live


def train_from_csv(
    spark: SparkSession, source: str, test_days: int = TEST_DAYS, inputs: list[str] = FEATURES,
    rejects: str | None = None, target: str | None = None, **settings: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transactions in CSV to predictions, their metrics and the importances of the
    inputs. With ``target`` the predictions are published there as the next version of the
    table, for reports to find with `read_published`.

    Lines that do not fit their columns, or have no date, are never left out in silence: their
    text goes to ``rejects``, a folder, and without one the first of them is an error.
    """
    lines = read_csv(spark, source, mode="PERMISSIVE" if rejects else "FAILFAST",
                     bad_column="line" if rejects else None)
    if rejects:
        lines = stored(lines, "csv-lines")
        fitting = lines.where("line is null").drop("line")
        sales, undated = dated(fitting)
        lines.where("line is not null").select("line").unionByName(
            undated.select(F.to_csv(F.struct("*")).alias("line"))).write.mode("overwrite").text(rejects)
    else:
        missing = F.raise_error(F.lit("a line has no date; name a folder for rejects to go on without it"))
        sales = lines.withColumn("date", F.coalesce("date", missing.cast("date")))
    forest, predictions = train_and_predict(daily_rollup(sales), test_days, inputs, **settings)
    if target:
        version = publish_table(predictions, target)
        predictions, _ = read_published(spark, target, PREDICTION, version)
    else:
        predictions = stored(predictions, "predictions")
    return predictions, evaluate.metrics(predictions), model.importances(forest, predictions, inputs)


def publish_csv(
    spark: SparkSession, source: str, fmt: str = "kafka", limit: int | None = None, **options: str
) -> None:
    """Transactions in CSV to messages of a topic, from all executors at once, also those of a
    ``limit``. A consumer sets the pace by the size of its batches."""
    lines = read_csv(spark, source)
    publish(lines if limit is None else first_rows(lines, limit), fmt, **options)


def start_live(
    messages: DataFrame, raw: live.BatchSink, totals: live.BatchSink, checkpoint: str,
    carry: tuple[str, ...] = (), permissive: bool = False, rejects: live.BatchSink | None = None,
    **trigger,
) -> tuple[StreamingQuery, ...]:
    """Both live queries over one stream definition, and with ``rejects`` a third for the
    messages they leave out; each keeps its own place in the stream, so their tables may for
    a moment be a batch apart."""
    rejected = () if rejects is None else (
        live.start_rejects(messages, rejects, f"{checkpoint}/rejects", **trigger),)
    return (
        live.start_raw(
            messages, raw, f"{checkpoint}/raw", permissive=permissive, carry=carry, **trigger
        ),
        live.start_totals(
            messages, totals, f"{checkpoint}/totals", permissive=permissive, **trigger
        ),
        *rejected,
    )
