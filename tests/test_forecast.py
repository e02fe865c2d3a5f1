import math
import random

import numpy as np
import pytest

from signalwatch.operators import forecast, monitoring


@pytest.fixture(scope="module")
def patterns(spark):
    rng = random.Random(1)
    rows = []
    for day in range(1, 8):
        for hour in range(24):
            n = 50 + 5 * day + 30 * math.sin(2 * math.pi * hour / 24) + rng.gauss(0, 2)
            rows.append((day, hour, n, int(n * 0.8 + rng.random() * 5)))
    return spark.createDataFrame(
        rows, "day_of_week int, hour_of_day int, event_count double, unique_patients long"
    )


def test_features_drop_unusable_rows(spark):
    df = spark.createDataFrame(
        [("1", "6", "10", "5"), ("x", "6", "10", "5"), ("1", "6", None, "5")],
        "day_of_week string, hour_of_day string, event_count string, unique_patients string",
    )
    got = forecast.forecast_features(df).collect()
    assert len(got) == 1 and got[0].hour_sin == pytest.approx(1.0)


def test_split_depends_on_the_key_only(patterns):
    train, test = forecast.split_by_key(patterns)
    assert (train.count(), test.count()) == (134, 34)
    again = forecast.split_by_key(patterns.repartition(7))[1]
    key = ["day_of_week", "hour_of_day"]
    assert sorted(map(tuple, test.select(key).collect())) == sorted(
        map(tuple, again.select(key).collect())
    )


@pytest.mark.parametrize("features", [forecast.FEATURES_2, forecast.FEATURES_5])
def test_linear_model_is_least_squares(patterns, features):
    train, _ = forecast.split_by_key(forecast.forecast_features(patterns))
    coefs, intercept = forecast.linear_terms(forecast.fit_forecast(train, "linear", features))
    rows = train.select(*features, "event_count").toPandas().to_numpy()
    x = np.column_stack([rows[:, :-1], np.ones(len(rows))])
    want = np.linalg.lstsq(x, rows[:, -1], rcond=None)[0]
    assert [*coefs, intercept] == pytest.approx(list(want), rel=1e-6, abs=1e-6)


@pytest.mark.parametrize(
    "kind,params", [("linear", {}), ("random_forest", {"numTrees": 20}), ("gbt", {"maxIter": 15})]
)
def test_models_beat_the_mean(patterns, kind, params):
    train, test = forecast.split_by_key(forecast.forecast_features(patterns))
    model = forecast.fit_forecast(train, kind, forecast.FEATURES_5, params)
    scored = forecast.predict(model, test)
    rmse = forecast.regression_metrics(scored).first().rmse
    spread = test.agg({"event_count": "stddev_pop"}).first()[0]
    assert rmse < 0.8 * spread


def test_no_rows_no_model(patterns):
    empty = forecast.forecast_features(patterns).where("false")
    assert forecast.fit_forecast(empty, "linear", forecast.FEATURES_2) is None


@pytest.mark.parametrize("kind,params", [("random_forest", {"numTrees": 5}), ("gbt", {"maxIter": 5})])
def test_model_depends_on_the_rows_alone(patterns, kind, params):
    train, test = forecast.split_by_key(forecast.forecast_features(patterns))
    found = []
    for n in (1, 4, 16):
        model = forecast.fit_forecast(train.repartition(n), kind, forecast.FEATURES_5, params, partitions=3)
        rows = forecast.predict(model, test).select("day_of_week", "hour_of_day", "event_count_pred")
        found.append(sorted(map(tuple, rows.collect())))
    assert found[0] == found[1] == found[2]


def test_nothing_stays_cached_after_a_fit(spark, patterns):
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    train, _ = forecast.split_by_key(forecast.forecast_features(patterns))
    forecast.fit_forecast(train, "linear", forecast.FEATURES_2)
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_predictions_carry_the_run(patterns):
    train, test = forecast.split_by_key(forecast.forecast_features(patterns))
    model = forecast.fit_forecast(train, "linear", forecast.FEATURES_5)
    table = forecast.predictions(model, test, "r1")
    rows = table.collect()
    errors = [r.event_count_true - r.event_count_pred for r in rows]
    assert {r.run_id for r in rows} == {"r1"} and rows[0].predicted_at is not None
    assert rows[0].rmse == pytest.approx(math.sqrt(sum(e * e for e in errors) / len(errors)))
    assert rows[0].mae == pytest.approx(sum(map(abs, errors)) / len(errors))


def test_metrics_and_comparison(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (3.0, 1.0)], "event_count_true double, event_count_pred double"
    )
    metrics = forecast.regression_metrics(df)
    table = forecast.model_comparison({"a": metrics, "b": metrics}, "run")
    assert [(r.model_name, r.rmse, r.mae) for r in table.orderBy("model_name").collect()] == [
        ("a", math.sqrt(2.5), 1.5), ("b", math.sqrt(2.5), 1.5)
    ]


def test_baseline_leaves_rows_without_a_place_out(spark):
    df = spark.createDataFrame(
        [(None, None, 99.0), (1, 0, 1.0), (1, 1, 3.0), (1, 2, None), (1, 3, 5.0)],
        "day_of_week int, hour_of_day int, event_count double",
    )
    got = forecast.baseline_predictions(df, "lagged", 2).collect()
    assert [(r.hour_of_day, r.event_count_pred) for r in got] == [(3, 2.0)]


def test_unknown_baseline(patterns):
    with pytest.raises(ValueError):
        forecast.baseline_predictions(patterns, "oracle")


def test_drift(spark):
    runs = spark.createDataFrame(
        [("m", 1, 1.0), ("m", 2, 3.0), ("m", 4, 2.0), ("n", 1, 7.0)],
        "model_name string, run int, rmse double",
    )
    got = forecast.model_drift(runs, "run").orderBy("model_name", "run").collect()
    assert [r.rmse_change for r in got] == [None, 2.0, -1.0, None]
    assert got[3].rmse_stability == 0.0


def test_diagonal_and_error_by_hour(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 9.0), (1, 4.0, 4.0), (2, 1.0, 0.0)],
        "hour_of_day int, event_count_true double, event_count_pred double",
    )
    assert {r.diagonal for r in monitoring.diagonal_max(df).collect()} == {9.0}
    got = monitoring.error_by(df, ["hour_of_day"]).orderBy("hour_of_day").collect()
    assert [(r.total_abs_error, r.mean_abs_error) for r in got] == [(4.0, 2.0), (1.0, 1.0)]
