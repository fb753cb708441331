"""The revenue model: a random forest over the daily features."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.schema import FEATURES, LABEL, PREDICTION

# Fixed values.
TREES = 100
DEPTH = 8
SEED = 42

PARTS = 8  # partitions of the training frame; another number grows another forest


def assembled(df: DataFrame, inputs: list[str] = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(df)


def fit(
    train: DataFrame, inputs: list[str] = FEATURES, trees: int = TREES, depth: int = DEPTH,
    seed: int = SEED,
) -> RandomForestRegressionModel:
    """Train on a daily frame. The draw of rows per tree depends on how the rows
    are partitioned, so each day is given a place that depends on its date alone:
    the same days and seed then give the same forest on any cluster."""
    if train.isEmpty():
        raise ValueError("no days left to train on: the series is not longer than the holdout")
    pinned = assembled(train, inputs).repartition(PARTS, "date").sortWithinPartitions("date")
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=seed
    )
    return forest.fit(pinned)


def score(model: RandomForestRegressionModel, df: DataFrame, inputs: list[str] = FEATURES) -> DataFrame:
    return model.transform(assembled(df, inputs))


def prediction_table(scored: DataFrame, predicted: str = "prediction") -> DataFrame:
    """The columns that reports read, under their report names."""
    source = {"actual_revenue": LABEL, "predicted_revenue": predicted}
    return scored.select(*[
        F.col(source.get(f.name, f.name)).cast(f.dataType).alias(f.name)
        for f in PREDICTION.fields
    ])


def importances(model: RandomForestRegressionModel, df: DataFrame, inputs: list[str] = FEATURES) -> DataFrame:
    """Inputs by importance, greatest first. ``df`` only names the session."""
    rows = [(name, float(w)) for name, w in zip(inputs, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def evaluator(metric: str) -> RegressionEvaluator:
    """MLlib's own measure ("rmse", "mae", "r2") over a prediction table."""
    return RegressionEvaluator(
        labelCol="actual_revenue", predictionCol="predicted_revenue", metricName=metric
    )
