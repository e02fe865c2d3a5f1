"""Forecasts of event counts with Spark ML, their baselines and their errors."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.operators.keyed import attach
from signalwatch.operators.projections import coerce_numeric, drop_null_keys, with_cyclical
from signalwatch.operators.timeseries import lagged_mean, trailing_mean, with_lags

KEYS = ["day_of_week", "hour_of_day"]
FEATURES_2 = KEYS
FEATURES_5 = [*KEYS, "unique_patients", "hour_sin", "hour_cos"]

# Hyperparameters of the three models.
MODELS = {
    "random_forest": (
        RandomForestRegressor,
        {"numTrees": 100, "maxDepth": 10, "featureSubsetStrategy": "all", "seed": 42},
    ),
    "linear": (LinearRegression, {"solver": "normal", "regParam": 0.0}),
    "gbt": (
        GBTRegressor,
        {"maxIter": 200, "stepSize": 0.05, "maxDepth": 3, "subsamplingRate": 0.9, "seed": 42},
    ),
}


def forecast_features(df: DataFrame) -> DataFrame:
    """Numeric features and the target; rows with a missing key, patient count or target go."""
    numeric = [*KEYS, "unique_patients", "event_count"]
    return with_cyclical(drop_null_keys(coerce_numeric(df, numeric), numeric)).select(
        *FEATURES_5, "event_count"
    )


def hour_of_week() -> Column:
    return (F.col("day_of_week") * 24 + F.col("hour_of_day")).cast("bigint")


def split_by_key(
    df: DataFrame, key: Column | None = None, folds: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; every ``folds``-th key is for testing.

    The split depends on the key alone, so it stays the same however the rows are partitioned.
    """
    held_out = F.pmod(hour_of_week() if key is None else key, F.lit(folds)) == 0
    return df.where(~held_out), df.where(held_out)


def fit_forecast(
    train: DataFrame, kind: str, features: list[str], params: dict | None = None,
    target: str = "event_count", partitions: int = 8,
) -> PipelineModel | None:
    """Fit one of ``MODELS``; no usable rows give no model.

    Tree models draw samples per partition.  Rows are therefore dealt by a hash of their features into
    ``partitions`` and sorted in each, so a model depends on the rows and that number alone, not on
    how the table was read.
    """
    estimator, defaults = MODELS[kind]
    rows = train.select(*features, F.col(target).cast("double").alias(target))
    rows = rows.repartition(partitions, *features).sortWithinPartitions(*features, target).persist()
    try:
        if rows.isEmpty():
            return None
        return Pipeline(
            stages=[
                VectorAssembler(inputCols=features, outputCol="features"),
                estimator(
                    featuresCol="features", labelCol=target, predictionCol="event_count_pred",
                    **{**defaults, **(params or {})},
                ),
            ]
        ).fit(rows)
    finally:
        rows.unpersist()


def linear_terms(model: PipelineModel) -> tuple[list[float], float]:
    """Coefficients and intercept of a fitted linear model."""
    fitted = model.stages[-1]
    return [float(c) for c in fitted.coefficients], float(fitted.intercept)


def predict(model: PipelineModel, df: DataFrame, target: str = "event_count") -> DataFrame:
    """Rows with ``event_count_true`` and ``event_count_pred``."""
    return (
        model.transform(df)
        .withColumnRenamed(target, "event_count_true")
        .drop("features")
    )


def regression_metrics(
    df: DataFrame, truth: str = "event_count_true", pred: str = "event_count_pred",
    by: list[str] = (),
) -> DataFrame:
    """RMSE and MAE, overall or per key."""
    error = F.col(truth) - F.col(pred)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae")
    )


def predictions(
    model: PipelineModel, test: DataFrame, run_id: str, predicted_at: datetime | Column | None = None,
) -> DataFrame:
    """The rows of the predictions table: keys, truth, forecast and the run's errors."""
    scored = predict(model, test)
    errors = regression_metrics(scored).select(F.struct("rmse", "mae")).scalar()
    when = F.current_timestamp() if predicted_at is None else (
        predicted_at if isinstance(predicted_at, Column) else F.lit(predicted_at)
    )
    return scored.withColumn("_errors", errors).select(
        F.col("day_of_week").cast("int"),
        F.col("hour_of_day").cast("int"),
        F.col("unique_patients").cast("int"),
        F.col("event_count_true").cast("double"),
        "event_count_pred",
        F.col("_errors.rmse").alias("rmse"),
        F.col("_errors.mae").alias("mae"),
        F.lit(run_id).alias("run_id"),
        when.alias("predicted_at"),
    )


def against_mean(model: PipelineModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """The test rows with their truth, the numbers of rows, and whether the model's RMSE on them is below
    that of the mean of the training rows."""
    scored = predict(model, test)
    mean = train.agg(F.avg("event_count").alias("mean"), F.count("*").alias("rows"))
    error = F.col("event_count_true") - F.col("event_count_pred")
    plain = F.col("event_count_true") - mean.select("mean").scalar()
    totals = scored.select((error * error).alias("own"), (plain * plain).alias("plain")).agg(
        F.count("*").alias("rows"), (F.sum("own") < F.sum("plain")).alias("beats_mean")
    )
    return scored.select(
        F.col("day_of_week").cast("int"), F.col("hour_of_day").cast("int"), "event_count_true",
        mean.select("rows").scalar().alias("train_rows"),
        totals.select("rows").scalar().alias("test_rows"),
        totals.select("beats_mean").scalar().alias("beats_mean"),
    )


def fits_training(model: PipelineModel, train: DataFrame) -> DataFrame:
    """One row: the training rows, and whether the model's RMSE on them is below that of their mean."""
    scored = predict(model, train)
    error = F.col("event_count_true") - F.col("event_count_pred")
    return scored.agg(
        F.count("*").alias("train_rows"),
        (F.sqrt(F.avg(error * error)) < F.stddev_pop("event_count_true")).alias("fits_training"),
    )


def baseline_predictions(
    df: DataFrame, kind: str = "lagged", k: int = 3, by: list[str] = (),
    order: list[str] = KEYS, target: str = "event_count",
) -> DataFrame:
    """Forecast each row from its series: the mean of the ``k`` rows before it (``lagged``).

    ``trailing_inclusive`` also averages the row itself in; it knows the answer and is there only for
    comparison.  Rows without a place in the series or without a value are left out first.
    """
    df = drop_null_keys(df, [*order, target])
    if kind == "lagged":
        scored = lagged_mean(df, order, target, k, by, name="event_count_pred")
    elif kind == "trailing_inclusive":
        scored = trailing_mean(df, order, target, k, by, name="event_count_pred")
    else:
        raise ValueError(f"unknown baseline: {kind}")
    return scored.withColumnRenamed(target, "event_count_true")


def baseline_metrics(
    df: DataFrame, kind: str = "lagged", k: int = 3, by: list[str] = (),
    order: list[str] = KEYS, target: str = "event_count",
) -> DataFrame:
    return regression_metrics(baseline_predictions(df, kind, k, by, order, target), by=by)


def model_comparison(metrics: dict[str, DataFrame], run_id: str) -> DataFrame:
    """One row per model with its errors, from ``{model name: one-row metrics}``."""
    rows = [
        frame.select(
            F.lit(run_id).alias("run_id"), F.lit(name).alias("model_name"), "rmse", "mae"
        )
        for name, frame in metrics.items()
    ]
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row)
    return table


def metric_trend(comparison: DataFrame) -> DataFrame:
    """Errors per model and run."""
    return comparison.groupBy("model_name", "run_id").agg(
        F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae")
    )


def model_drift(comparison: DataFrame, order: str) -> DataFrame:
    """Change of each model's RMSE from run to run, and how much it varies over all runs."""
    spread = comparison.groupBy("model_name").agg(F.stddev_pop("rmse").alias("rmse_stability"))
    steps = with_lags(comparison, [order], "rmse", [1], ["model_name"])
    return (
        attach(steps, spread, ["model_name"])
        .withColumn("rmse_change", F.col("rmse") - F.col("rmse_lag_1"))
        .drop("rmse_lag_1")
    )
