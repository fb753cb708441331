"""Daily features, holdout, predictions."""

from __future__ import annotations

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame

from tillflow.operators import model
from tillflow.operators.features import daily_features
from tillflow.operators.split import TEST_DAYS, holdout, test_part, train_part
from tillflow.schema import FEATURES
from tillflow.session import stored


def baseline_predictions(daily: DataFrame, test_days: int = TEST_DAYS) -> DataFrame:
    """The held-out days predicted by their rolling mean: what a model must beat."""
    split = holdout(daily_features(daily), test_days)
    return model.prediction_table(test_part(split), "rolling_7day_avg_revenue")


def train_and_predict(
    daily: DataFrame, test_days: int = TEST_DAYS, inputs: list[str] = FEATURES,
    **settings: int,
) -> tuple[RandomForestRegressionModel, DataFrame]:
    """The model and its predictions of the held-out days.

    Training reads its rows many times over. The split, one row per day, is
    therefore stored first and the facts behind it are read once.
    """
    split = stored(holdout(daily_features(daily), test_days), "split")
    forest = model.fit(train_part(split), inputs, **settings)
    return forest, model.prediction_table(model.score(forest, test_part(split), inputs))
