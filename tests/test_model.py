import pytest
from conftest import SMALL, days
from pyspark.sql import functions as F

from tillflow.operators import evaluate, model, split
from tillflow.operators.features import daily_features
from tillflow.plans import forecast, retail
from tillflow.schema import FEATURES, KNOWN_AHEAD, PREDICTION
from tillflow.session import stored


@pytest.fixture(scope="module")
def daily(spark):
    return stored(retail.daily_revenue(spark, SMALL), "daily")


@pytest.fixture(scope="module")
def trained(daily):
    return forecast.train_and_predict(daily, trees=20)


def test_predictions_cover_the_holdout(daily, trained):
    predictions = trained[1]
    assert predictions.dtypes == [(f.name, f.dataType.simpleString()) for f in PREDICTION.fields]
    held_out = split.test_part(split.holdout(daily_features(daily)))
    assert {r.date for r in predictions.collect()} == {r.date for r in held_out.collect()}
    assert predictions.count() == 180


def test_same_days_and_seed_give_the_same_forest(daily, trained):
    shuffled = daily.repartition(7, "transaction_count")
    _, again = forecast.train_and_predict(shuffled, trees=20)
    assert sorted(again.collect()) == sorted(trained[1].collect())


def test_forest_beats_the_rolling_mean(daily, trained):
    ours = evaluate.metrics(trained[1]).first()
    baseline = evaluate.metrics(forecast.baseline_predictions(daily)).first()
    assert ours.r2 > baseline.r2 and ours.rmse < baseline.rmse


def test_importances_are_ranked_and_sum_to_one(daily, trained):
    rows = model.importances(trained[0], daily).collect()
    assert {r.feature for r in rows} == set(FEATURES)
    weights = [r.importance for r in rows]
    assert weights == sorted(weights, reverse=True)
    assert sum(weights) == pytest.approx(1.0)


def test_features_known_ahead_can_be_used_alone(daily):
    forest, predictions = forecast.train_and_predict(daily, inputs=KNOWN_AHEAD, trees=5)
    assert forest.numFeatures == len(KNOWN_AHEAD) == 6
    assert predictions.count() == 180


def test_a_series_no_longer_than_the_holdout_is_refused(make_daily):
    short = make_daily(*zip(days("2024-01-01", 181), range(181))).withColumns({
        "daily_units_sold": F.lit(1), "promo_rate": F.lit(0.0),
        "avg_discount_pct": F.lit(0.0), "transaction_count": F.lit(1),
    })
    with pytest.raises(ValueError, match="no days left"):
        forecast.train_and_predict(short)
