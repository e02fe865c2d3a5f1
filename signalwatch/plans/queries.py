"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch import adapters as A
from signalwatch.operators import (
    alerts, analytics, anomaly, forecast, ingest, matching, monitoring, projections, quality, timeseries,
)
from signalwatch.operators.projections import ordered
from signalwatch.schemas import ROUTES, SYMPTOM_REPORT
from signalwatch.session import run_dir
from signalwatch.sources import readers, sinks
from signalwatch.streaming import jobs, streams

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
T = "event_timestamp"

# Thresholds low enough for the sparse test tables; the operators' defaults are the real ones.
CONFIG = {"volume_threshold": 80, "lookback_minutes": 1440, "poll_interval_seconds": 3600,
          "cooldown_minutes": 360, "top_n_regions": 2}
TOPICS = {
    "symptom_report": "typed.symptom_reports",
    "clinic_visit": "typed.clinic_visits",
    "environmental_conditions": "typed.environmental_conditions",
}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# -- inputs --------------------------------------------------------------------------------------


def _symptoms(spark, sf_dir):
    return A.symptom_reports(A.events(spark, sf_dir))


def _env(spark, sf_dir):
    return A.environmental_conditions(A.events(spark, sf_dir))


def _dq(spark, sf_dir):
    return A.dq_events(A.events(spark, sf_dir))


def _raw(spark, sf_dir):
    return A.raw_messages(A.events(spark, sf_dir))


def _patterns(spark, sf_dir):
    return analytics.temporal_patterns(_symptoms(spark, sf_dir))


def _patterns_table(spark, sf_dir):
    """The same as a stored table, for queries that use it more than once."""
    return sinks.feature_table(_patterns(spark, sf_dir), "temporal_patterns")


def _pattern_counts(spark, sf_dir):
    return _patterns(spark, sf_dir).select("day_of_week", "hour_of_day", "event_count")


def _daily_windows(spark, sf_dir):
    """Events of the last 24 hours per region, evaluated every hour."""
    return timeseries.sliding_counts(
        projections.not_null(_symptoms(spark, sf_dir), ["region"]), T, "24 hours", "1 hour",
        ["region"],
    )


def _stream(spark, sf_dir):
    """The event table as a stream of files; the glob matches one file or a folder of files."""
    path = A.table_path(sf_dir, "events")[:-1] + "*"
    return readers.read_event_stream(
        spark, "parquet", {"maxFilesPerTrigger": "1000"}, A.EVENTS_SCHEMA, path
    )


def _run(df, sink, name, **kw):
    """Run a stream over what there is now, with one state partition per core of the cluster."""
    spark = df.sparkSession
    streams.start_stream(
        df, sink, name, run_dir(spark, f"{name}-checkpoint"), trigger="availableNow",
        state_partitions=spark.sparkContext.defaultParallelism, **kw,
    ).awaitTermination()


# -- sources and sinks ---------------------------------------------------------------------------


@query
def scan_parquet(spark, sf_dir):
    path = A.table_path(sf_dir, "events")
    return readers.read_table(spark, path, fmt="parquet", schema=A.EVENTS_SCHEMA).select(
        "event_id", "ts", "value"
    )


@query
def load_projection(spark, sf_dir):
    return readers.select_feature(
        _symptoms(spark, sf_dir), ["event_id", "region", "patient_id"], ["region", "patient_id"]
    )


@query
def decode_json_props(spark, sf_dir):
    return readers.decode_json(A.events(spark, sf_dir), "k int", "props")


@query
def publish_payload(spark, sf_dir):
    decoded = readers.decode_json(_raw(spark, sf_dir), SYMPTOM_REPORT)
    return sinks.topic_payload(
        decoded.select("event_id", "event_type", "patient_id", "region", "symptoms"), TOPICS
    )


@query
def archive_by_type(spark, sf_dir):
    routed = ingest.with_route(ingest.extract_type(_raw(spark, sf_dir)))
    events = readers.decode_json(
        routed.where(F.col("route") != ingest.UNMATCHED), SYMPTOM_REPORT
    )
    path = run_dir(spark, "archive")
    sinks.archive_by_type(events, path)
    return (
        spark.read.schema(SYMPTOM_REPORT).json(path)
        .select("event_id", "event_type", "timestamp", "symptoms")
    )


@query
def archive_in_files(spark, sf_dir):
    """The archive in files of bounded size: rows per type, and the files that hold them."""
    routed = ingest.with_route(ingest.extract_type(_raw(spark, sf_dir)))
    events = readers.decode_json(routed.where(F.col("route") != ingest.UNMATCHED), SYMPTOM_REPORT)
    path = run_dir(spark, "archive_in_files")
    for _ in range(2):  # a batch that is written again replaces itself
        sinks.archive_by_type(events, path, rows_per_file=1000)
    back = spark.read.schema(SYMPTOM_REPORT).json(path).withColumn("_file", F.input_file_name())
    return back.groupBy("event_type").agg(
        F.count("*").alias("row_count"), (F.count_distinct("_file") <= F.ceil(F.count("*") / 1000)).alias("few_files")
    )


@query
def snapshot_sink(spark, sf_dir):
    path = run_dir(spark, "snapshot")
    write = sinks.snapshot_sink(path)
    table = analytics.symptom_by_region(_symptoms(spark, sf_dir))
    write(table.withColumn("event_count", F.col("event_count") * 2), 0)
    write(table, 1)
    return sinks.read_snapshot(spark, path)


@query
def append_sink(spark, sf_dir):
    path = run_dir(spark, "append")
    write = sinks.append_sink(path)
    metrics = quality.dq_metrics(quality.validate(_dq(spark, sf_dir)), stamp_time=False)
    for batch_id in (0, 1, 1):
        write(metrics, batch_id)
    return sinks.read_history(spark, path).select(
        "batch_id", "total_records", "dq_fail", "rows_with_any_failure"
    )


# -- routing and enrichment ----------------------------------------------------------------------


@query
def route_events(spark, sf_dir):
    routed = ingest.with_route(ingest.extract_type(_raw(spark, sf_dir)))
    return routed.select(F.col("key").alias("event_id"), "event_type", "route")


@query
def enrich_events(spark, sf_dir):
    decoded = readers.decode_json(_raw(spark, sf_dir), SYMPTOM_REPORT)
    branches = ingest.route(decoded)
    now = F.lit("2024-02-01 12:00:00").cast("timestamp")
    rows = [ingest.enrich(branches[name], "gateway", "team-a", now) for name in ROUTES]
    return reduce(DataFrame.unionByName, rows).select(
        "event_id", "event_type", "region", "processing_timestamp", "event_source", "team_id"
    )


@query
def parse_event_time(spark, sf_dir):
    decoded = readers.decode_json(_raw(spark, sf_dir), SYMPTOM_REPORT)
    return ingest.with_event_time(decoded).select("event_id", T)


@query
def severity_score(spark, sf_dir):
    return ingest.with_severity_score(_symptoms(spark, sf_dir)).select(
        "event_id", "severity", "severity_score"
    )


@query
def symptoms_text(spark, sf_dir):
    listed = _symptoms(spark, sf_dir).withColumn("symptoms", F.array("symptoms", "severity"))
    return ingest.explode_symptoms(ingest.symptoms_as_text(listed)).select(
        "event_id", "symptoms", "symptom"
    )


# -- row-wise ------------------------------------------------------------------------------------


@query
def cyclical_hour(spark, sf_dir):
    hours = projections.with_time_parts(_symptoms(spark, sf_dir), T)
    return projections.with_cyclical(hours).select(
        "event_id", "day_of_week", "hour_of_day", "hour_sin", "hour_cos"
    )


@query
def coerce_numeric(spark, sf_dir):
    text = A.events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 71 == 0, "n/a")
        .otherwise(F.get_json_object("props", "$.k")).alias("k"),
    )
    return projections.coerce_numeric(text, ["k"])


@query
def drop_null_keys(spark, sf_dir):
    keys = ["region", "patient_id"]
    return projections.drop_null_keys(_symptoms(spark, sf_dir), keys).select("event_id", *keys)


# -- aggregates ----------------------------------------------------------------------------------


@query
def symptom_by_region(spark, sf_dir):
    return analytics.symptom_by_region(_symptoms(spark, sf_dir))


@query
def severity_by_hour(spark, sf_dir):
    return analytics.share_of_total(
        analytics.severity_by_hour(_symptoms(spark, sf_dir)), "event_count"
    )


@query
def severity_share_by_hour(spark, sf_dir):
    return analytics.share_of_total(
        analytics.severity_by_hour(_symptoms(spark, sf_dir)), "event_count", ["hour_of_day"]
    )


@query
def temporal_patterns(spark, sf_dir):
    return ordered(_patterns(spark, sf_dir), ["day_of_week", "hour_of_day"])


@query
def env_avg_temp(spark, sf_dir):
    return analytics.env_avg_temp(_env(spark, sf_dir))


@query
def env_air_quality(spark, sf_dir):
    return analytics.env_air_quality(_env(spark, sf_dir))


@query
def env_hourly(spark, sf_dir):
    return analytics.env_hourly(_env(spark, sf_dir))


@query
def lookback_region_events(spark, sf_dir):
    return analytics.events_by_region(_symptoms(spark, sf_dir), T, 1440)


@query
def severity_share(spark, sf_dir):
    return analytics.severity_share(_symptoms(spark, sf_dir))


@query
def lookback_severity_share(spark, sf_dir):
    return analytics.severity_share(_symptoms(spark, sf_dir), T, 1440)


@query
def severity_hour_pivot(spark, sf_dir):
    counts = analytics.severity_by_hour(_symptoms(spark, sf_dir))
    return analytics.pivot_counts(
        counts, "severity", "hour_of_day", list(range(24)), "event_count", "h"
    )


@query
def avg_events_by_hour(spark, sf_dir):
    return analytics.avg_by(_pattern_counts(spark, sf_dir), ["hour_of_day"], "event_count")


@query
def top10_regions(spark, sf_dir):
    return analytics.region_totals(analytics.symptom_by_region(_symptoms(spark, sf_dir)), 10)


# -- windows and series --------------------------------------------------------------------------


@query
def bucket_5min_filled(spark, sf_dir):
    return timeseries.bucket_counts(_symptoms(spark, sf_dir), T, "5 minutes")


@query
def rolling_30min(spark, sf_dir):
    return timeseries.trailing_mean(
        bucket_5min_filled(spark, sf_dir), ["bucket"], "event_count", 6, width="5 minutes",
        name="rolling_30min",
    )


@query
def anomaly_overlay(spark, sf_dir):
    counts = timeseries.bucket_counts(_symptoms(spark, sf_dir), T, "5 minutes", fill=False)
    return timeseries.anomaly_overlay(
        rolling_30min(spark, sf_dir).select("bucket", "rolling_30min"),
        anomaly.zscore_anomalies(counts, "event_count"), "bucket", "rolling_30min",
    )


@query
def tumbling_region_counts(spark, sf_dir):
    return timeseries.tumbling_counts(_symptoms(spark, sf_dir), T, "5 minutes", ["region"])


@query
def sliding_region_counts(spark, sf_dir):
    return _daily_windows(spark, sf_dir)


@query
def sliding_every_slide(spark, sf_dir):
    return timeseries.sliding_counts(
        _symptoms(spark, sf_dir), T, "6 hours", "1 hour", ["region"], every_slide=True
    )


@query
def rolling_baseline_k3(spark, sf_dir):
    return forecast.baseline_predictions(_pattern_counts(spark, sf_dir), "lagged", 3)


@query
def rolling_trailing5(spark, sf_dir):
    return forecast.baseline_predictions(
        _pattern_counts(spark, sf_dir), "trailing_inclusive", 5
    )


@query
def baseline_ratio(spark, sf_dir):
    hourly = timeseries.bucket_counts(_symptoms(spark, sf_dir), T, "1 hour", ["region"])
    return timeseries.baseline_ratio(
        hourly, "bucket", "event_count", "1 hour", 6, 24, ["region"]
    )


@query
def rolling_24h(spark, sf_dir):
    hourly = timeseries.bucket_counts(
        _symptoms(spark, sf_dir), T, "1 hour", ["region"], fill=False
    )
    return timeseries.rolling_sum(
        hourly, "bucket", "event_count", 24, ["region"], name="events_24h"
    )


def _lags_as_double(df):
    """Counts that may be missing as doubles, which both engines hand out the same way."""
    return df.withColumns(
        {c: F.col(c).cast("double") for c in df.columns if c.startswith("event_count_lag")}
    )


@query
def lag_features(spark, sf_dir):
    counts = _patterns_table(spark, sf_dir).select("day_of_week", "hour_of_day", "event_count")
    return _lags_as_double(
        timeseries.with_lags(counts, ["day_of_week", "hour_of_day"], "event_count", [1, 2, 3])
    )


@query
def hourly_lag_features(spark, sf_dir):
    hourly = timeseries.bucket_counts(_symptoms(spark, sf_dir), T, "1 hour", ["region"])
    return _lags_as_double(
        timeseries.with_lags(
            hourly, ["bucket"], "event_count", [1, 2, 3], ["region"], "1 hour"
        )
    )


@query
def sustained_deviation(spark, sf_dir):
    return timeseries.sustained(
        _daily_windows(spark, sf_dir), ["window_end"], "event_count", 100, 3, ["region"], "1 hour"
    )


@query
def region_timeline(spark, sf_dir):
    return monitoring.region_timeline(
        timeseries.tumbling_counts(_symptoms(spark, sf_dir), T, "1 hour", ["region"])
    )


# -- anomalies and alerts ------------------------------------------------------------------------


@query
def zscore_anomalies(spark, sf_dir):
    table = sinks.feature_table(
        analytics.symptom_by_region(_symptoms(spark, sf_dir)), "symptom_by_region"
    )
    return anomaly.zscore_anomalies(table, "event_count", threshold=1.2)


@query
def append_anomalies(spark, sf_dir):
    table = sinks.feature_table(
        analytics.symptom_by_region(_symptoms(spark, sf_dir)), "symptom_by_region"
    )
    out = run_dir(spark, "append_anomalies")
    for _ in range(2):  # a repeated run replaces its own rows
        jobs.run_anomalies(table, out, "run_a", threshold=1.2)
    return sinks.read_history(spark, out).drop("detected_at")


@query
def job_basic_alerts(spark, sf_dir):
    return jobs.run_basic_alerts(
        _symptoms(spark, sf_dir), T, minutes=1440, volume=20, severe_share=5.0
    )


def _hourly(spark, sf_dir, by=()):
    return timeseries.bucket_counts(_symptoms(spark, sf_dir), T, "1 hour", list(by), fill=False)


@query
def zscore_hourly(spark, sf_dir):
    return anomaly.zscore_anomalies(_hourly(spark, sf_dir), "event_count")


@query
def zscore_by_region(spark, sf_dir):
    return anomaly.zscore_anomalies(
        _hourly(spark, sf_dir, ["region"]), "event_count", ["region"]
    )


@query
def zscore_running(spark, sf_dir):
    """The newest day's hours against all days: its moments are merged into the stored ones of the days before."""
    hourly = sinks.feature_table(
        projections.not_null(_hourly(spark, sf_dir, ["region"]), ["region"]).withColumn("day", F.to_date("bucket")), "hourly_counts"
    )
    path = run_dir(spark, "daily_moments")
    newest = hourly.agg(F.max("day")).first()[0]
    before, today = hourly.where(F.col("day") < F.lit(newest)), hourly.where(F.col("day") == F.lit(newest))
    sinks.append_result(anomaly.moments(before, "event_count", ["region", "day"]), path, "before")
    for _ in range(2):  # a day that is added again replaces itself
        known = anomaly.update_moments(today, path, "newest", "event_count", ["region"])
    return anomaly.score_with_moments(today.drop("day"), "event_count", known, ["region"])


@query
def zscore_history(spark, sf_dir):
    return timeseries.history_zscore(
        _hourly(spark, sf_dir, ["region"]), "bucket", "event_count", "1 hour", 24, ["region"]
    )


@query
def alert_volume(spark, sf_dir):
    return alerts.volume_alerts(_daily_windows(spark, sf_dir), 100)


@query
def alert_severe_share(spark, sf_dir):
    return alerts.share_alerts(_symptoms(spark, sf_dir), T, "1 day", threshold=16)


@query
def alert_level(spark, sf_dir):
    return alerts.alert_level(_daily_windows(spark, sf_dir), CONFIG)


@query
def alert_level_history(spark, sf_dir):
    return alerts.alert_level(_daily_windows(spark, sf_dir), CONFIG, history=("1 hour", 24))


@query
def alert_top_regions(spark, sf_dir):
    hot = alerts.volume_alerts(_daily_windows(spark, sf_dir), CONFIG["volume_threshold"])
    return alerts.top_regions(hot, CONFIG["top_n_regions"])


def _hourly_table(spark, sf_dir):
    """Stored counts per hour, region and severity, from one pass over the events."""
    return sinks.feature_table(
        timeseries.bucket_counts(
            _symptoms(spark, sf_dir), T, "1 hour", ["region", "severity"], fill=False
        ),
        "hourly_counts",
    )


def _advanced(spark, sf_dir, cooldown_keys=None):
    hourly = _hourly_table(spark, sf_dir)
    return alerts.advanced_alerts(
        *[
            timeseries.sliding_counts(
                hourly, "bucket", "24 hours", "1 hour", [key], "event_count"
            )
            for key in ("region", "severity")
        ],
        CONFIG, cooldown_keys=cooldown_keys,
    )


@query
def alert_advanced(spark, sf_dir):
    return _advanced(spark, sf_dir).select(
        "window_start", "window_end", "level", "hot_regions",
        F.size("mix").alias("severities"),
        F.posexplode("regions").alias("place", "r"),
    ).select("*", "r.region", "r.events", "r.z_score").drop("r")


@query
def alert_cooldown(spark, sf_dir):
    return alerts.apply_cooldown(alert_volume(spark, sf_dir), "window_end", ["region"], 360)


@query
def alert_cooldown_global(spark, sf_dir):
    return alerts.apply_cooldown(alert_level(spark, sf_dir), "window_end", [], 360)


@query
def alert_messages(spark, sf_dir):
    return alerts.format_alert(_advanced(spark, sf_dir, []), CONFIG).select("window_end", "level", "message")


@query
def alert_messages_basic(spark, sf_dir):
    hourly = _hourly_table(spark, sf_dir)
    windows = timeseries.sliding_counts(
        hourly, "bucket", "24 hours", "1 hour", ["region"], "event_count"
    )
    volume = alerts.format_volume_alert(alerts.volume_alerts(windows, 100), 100, 1440)
    severe = alerts.share_alerts(
        hourly, "bucket", "1 day", threshold=16, value="event_count"
    )
    share = alerts.format_share_alert(severe, 16.0).select("window_end", "message")
    return volume.unionByName(share)


@query
def alert_lines(spark, sf_dir):
    hourly = _hourly_table(spark, sf_dir)
    windows = timeseries.sliding_counts(hourly, "bucket", "24 hours", "1 hour", ["region"], "event_count")
    return alerts.volume_alert_lines(alerts.volume_alerts(windows, 100), 100, 1440)


@query
def alert_multi_metric(spark, sf_dir):
    known = projections.not_null(_symptoms(spark, sf_dir), ["region"])
    daily = sinks.feature_table(
        timeseries.tumbling_counts(known, T, "1 day", ["region"]), "daily_counts"
    )
    strength = anomaly.with_zscore(daily, "event_count", ["region"])
    flagged = quality.validate(_dq(spark, sf_dir)).withColumn(
        "window_start", F.window(T, "1 day").start
    )
    failing = quality.dq_metrics(flagged, ["window_start", "region"], stamp_time=False).select(
        "window_start", "region",
        F.try_divide(100.0 * F.col("rows_with_any_failure"), F.col("total_records"))
        .alias("dq_failure_rate"),
    )
    return alerts.multi_metric_alerts(
        [strength, failing], ["window_start", "region"],
        {"z_score": 0.5, "event_count": 50, "dq_failure_rate": 25},
    )


@query
def alert_multi_metric_in_time(spark, sf_dir):
    """Busy, unusual days of a region whose newest quality evaluation, every 7 hours, is bad.

    One pass over the events gives the hourly counts that all views come from.
    """
    checked = quality.validate(_dq(spark, sf_dir)).where("region is not null")
    hourly = sinks.feature_table(
        checked.groupBy(timeseries.bucket_start(timeseries.bucket_number(T, "1 hour"), "1 hour").alias("hour"), "region")
        .agg(F.count("*").alias("event_count"), F.count_if(F.col("dq_fail") > 0).alias("failing")),
        "hourly_quality",
    )
    daily = timeseries.tumbling_counts(hourly, "hour", "1 day", ["region"], "event_count")
    evaluated = timeseries.tumbling_counts(hourly, "hour", "7 hours", ["region"], "failing").withColumnRenamed("event_count", "failing")
    totals = timeseries.tumbling_counts(hourly, "hour", "7 hours", ["region"], "event_count")
    quality_rows = evaluated.join(totals, ["window_start", "window_end", "region"]).select(
        "region", F.col("window_end").alias("evaluated_at"),
        F.try_divide(100.0 * F.col("failing"), F.col("event_count")).alias("dq_failure_rate"),
    )
    return alerts.multi_metric_in_time(
        anomaly.with_zscore(daily, "event_count", ["region"]), [(quality_rows, "evaluated_at")], "window_end", ["region"],
        {"z_score": 0.0, "event_count": 20, "dq_failure_rate": 20}, within="1 day",
    )


# -- data quality --------------------------------------------------------------------------------


@query
def dq_row_flags(spark, sf_dir):
    flagged = quality.validate(_dq(spark, sf_dir))
    return flagged.select("event_id", *quality.fail_columns(flagged), "dq_fail")


@query
def dq_metrics(spark, sf_dir):
    return quality.dq_metrics(quality.validate(_dq(spark, sf_dir)), stamp_time=False)


@query
def dq_metrics_by_day(spark, sf_dir):
    daily = quality.dq_by_day(quality.validate(_dq(spark, sf_dir)), T)
    return daily.withColumn("day", F.col("day").cast("timestamp"))


@query
def dq_rollup(spark, sf_dir):
    text = _dq(spark, sf_dir).withColumn(
        "value",
        F.when(F.col("event_id") % 71 == 0, "{broken").otherwise(
            F.to_json(F.struct("temperature", "humidity", "symptom_count", "region"))
        ),
    )
    columns = ["temperature", "humidity", "symptom_count", "region"]
    decoded = readers.decode_json(
        text, "temperature double, humidity double, symptom_count int, region string"
    )
    flagged = quality.validate(quality.schema_flags(decoded, columns))
    return quality.dq_rollup(quality.dq_metrics(flagged, stamp_time=False))


# -- forecasts -----------------------------------------------------------------------------------


@query
def forecast_features(spark, sf_dir):
    return forecast.forecast_features(_patterns(spark, sf_dir))


@query
def forecast_split(spark, sf_dir):
    train, test = forecast.split_by_key(_patterns_table(spark, sf_dir).drop(
        "unique_patients", "patient_rows"
    ))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


_FITTED: dict[tuple, object] = {}


def _fit(spark, sf_dir, kind, features):
    """A model with its training and test rows; queries over the same tables share the model."""
    patterns = _patterns_table(spark, sf_dir)
    train, test = forecast.split_by_key(forecast.forecast_features(patterns))
    name = (spark.sparkContext.applicationId, sf_dir, kind, *features)
    if name not in _FITTED:
        # hours of the week: 168 rows at most
        _FITTED[name] = forecast.fit_forecast(train, kind, features, partitions=1)
    return _FITTED[name], train, test


def _scored(spark, sf_dir, kind, features):
    model, _, test = _fit(spark, sf_dir, kind, features)
    when = F.lit("2025-01-01 00:00:00").cast("timestamp")
    return forecast.predictions(model, test, f"run_{kind}", when)


@query
def forecast_linear2(spark, sf_dir):
    model, _, test = _fit(spark, sf_dir, "linear", forecast.FEATURES_2)
    (by_day, by_hour), intercept = forecast.linear_terms(model)
    return forecast.regression_metrics(forecast.predict(model, test)).select(
        F.lit(by_day).alias("coef_day"), F.lit(by_hour).alias("coef_hour"),
        F.lit(intercept).alias("intercept"), "rmse", "mae",
    )


@query
def forecast_predictions(spark, sf_dir):
    return _scored(spark, sf_dir, "linear", forecast.FEATURES_2)


@query
def forecast_linear5(spark, sf_dir):
    return _scored(spark, sf_dir, "linear", forecast.FEATURES_5)


@query
def forecast_random_forest(spark, sf_dir):
    return forecast.against_mean(
        *_fit(spark, sf_dir, "random_forest", forecast.FEATURES_5)
    )


@query
def forecast_gbt(spark, sf_dir):
    # whether boosting beats the mean depends on the size of the tables: see models_against_mean
    return forecast.against_mean(
        *_fit(spark, sf_dir, "gbt", forecast.FEATURES_2)
    ).drop("beats_mean")


@query
def forecast_metrics(spark, sf_dir):
    counts = _pattern_counts(spark, sf_dir)
    return forecast.model_comparison(
        {
            "lagged_k3": forecast.baseline_metrics(counts, "lagged", 3),
            "trailing_inclusive_5": forecast.baseline_metrics(counts, "trailing_inclusive", 5),
        },
        "all_rows",
    ).drop("run_id")


_KINDS = {
    "linear_regression": ("linear", forecast.FEATURES_2),
    "random_forest": ("random_forest", forecast.FEATURES_5),
    "gradient_boosting": ("gbt", forecast.FEATURES_2),
}


@query
def model_comparison(spark, sf_dir):
    patterns = _patterns_table(spark, sf_dir)
    counts = patterns.select("day_of_week", "hour_of_day", "event_count")
    model, _, test = _fit(spark, sf_dir, "linear", forecast.FEATURES_2)

    def held_out(scored):
        return forecast.regression_metrics(forecast.split_by_key(scored)[1])

    return forecast.model_comparison(
        {
            "rolling_avg_k=3": held_out(forecast.baseline_predictions(counts, "lagged", 3)),
            "trailing_inclusive_5": held_out(
                forecast.baseline_predictions(counts, "trailing_inclusive", 5)
            ),
            "linear_regression": forecast.regression_metrics(forecast.predict(model, test)),
        },
        "run_1",
    )


@query
def models_against_mean(spark, sf_dir):
    rows = [
        forecast.against_mean(*_fit(spark, sf_dir, kind, features))
        .select(F.lit(name).alias("model_name"), "train_rows", "test_rows", "beats_mean").limit(1)
        for name, (kind, features) in _KINDS.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def models_fit_training(spark, sf_dir):
    """Every model explains its training rows better than their mean does."""
    fits = []
    for name, (kind, features) in _KINDS.items():
        model, train, _ = _fit(spark, sf_dir, kind, features)
        fits.append(forecast.fits_training(model, train).withColumn("model_name", F.lit(name)))
    return reduce(DataFrame.unionByName, fits)


@query
def model_comparison_all(spark, sf_dir):
    """Baselines, linear, forest and boosting, all scored on the same held-out rows."""
    counts = _pattern_counts(spark, sf_dir)
    scored = {
        "rolling_avg_k=3": forecast.split_by_key(forecast.baseline_predictions(counts, "lagged", 3))[1],
        "trailing_inclusive_5": forecast.split_by_key(forecast.baseline_predictions(counts, "trailing_inclusive", 5))[1],
    }
    for name, (kind, features) in _KINDS.items():
        model, _, test = _fit(spark, sf_dir, kind, features)
        scored[name] = forecast.predict(model, test)
    return forecast.model_comparison({name: forecast.regression_metrics(df) for name, df in scored.items()}, "run_1")


@query
def true_vs_pred(spark, sf_dir):
    return monitoring.diagonal_max(rolling_baseline_k3(spark, sf_dir))


@query
def error_by_hour(spark, sf_dir):
    return monitoring.error_by(rolling_baseline_k3(spark, sf_dir), ["hour_of_day"])


# -- monitoring ----------------------------------------------------------------------------------


def _weekly_runs(spark, sf_dir):
    """Errors of the two baselines, one run per week of events."""
    run = F.floor(F.unix_seconds(T) / 604800).cast("bigint")
    weekly = (
        projections.with_time_parts(_symptoms(spark, sf_dir), T)
        .groupBy(run.alias("run"), "day_of_week", "hour_of_day")
        .agg(F.count("*").alias("event_count"))
    )
    frames = {
        "lagged_k3": forecast.baseline_metrics(weekly, "lagged", 3, ["run"]),
        "trailing_inclusive_5": forecast.baseline_metrics(
            weekly, "trailing_inclusive", 5, ["run"]
        ),
    }
    tables = [
        frame.select(
            "run", F.concat(F.lit("run_"), F.col("run").cast("string")).alias("run_id"),
            F.lit(name).alias("model_name"), "rmse", "mae",
        )
        for name, frame in frames.items()
    ]
    return tables[0].unionByName(tables[1])


@query
def model_metric_trend(spark, sf_dir):
    return forecast.metric_trend(_weekly_runs(spark, sf_dir))


@query
def model_drift(spark, sf_dir):
    runs = sinks.feature_table(_weekly_runs(spark, sf_dir).drop("mae"), "model_comparison")
    return forecast.model_drift(runs, "run")


@query
def anomaly_strength(spark, sf_dir):
    hourly = sinks.feature_table(_hourly(spark, sf_dir), "hourly_counts")
    scored = anomaly.with_zscore(hourly, "event_count")
    return monitoring.anomaly_strength(scored, "bucket", "1 day")


@query
def top_anomalous_regions(spark, sf_dir):
    known = projections.not_null(_symptoms(spark, sf_dir), ["region"])
    hourly = timeseries.bucket_counts(known, T, "1 hour", ["region"], fill=False)
    return monitoring.top_anomalous(anomaly.with_zscore(hourly, "event_count", ["region"]))


@query
def table_freshness(spark, sf_dir):
    return monitoring.table_freshness(
        {
            "symptom_reports": _symptoms(spark, sf_dir),
            "environmental_conditions": _env(spark, sf_dir),
            "dq_events": _dq(spark, sf_dir),
        },
        T,
    )


# -- the same operators on other tables ----------------------------------------------------------

LINEITEM_RULES = {
    "l_quantity": {"min": 1, "max": 45},
    "l_discount": {"max": 0.09},
    "l_returnflag": {"allowed": ["A", "N"]},
}
ORDERS_SCHEMA = "o_orderkey bigint, o_orderdate timestamp, o_orderpriority string"


def _orders(spark, sf_dir):
    return spark.read.schema(ORDERS_SCHEMA).parquet(A.table_path(sf_dir, "orders"))


@query
def lineitem_dq_metrics(spark, sf_dir):
    lines = spark.read.parquet(A.table_path(sf_dir, "lineitem"))
    flagged = quality.validate(lines, LINEITEM_RULES, tuple(LINEITEM_RULES))
    return quality.dq_metrics(flagged, ["l_linestatus"], stamp_time=False)


@query
def orders_priority_share(spark, sf_dir):
    counts = (
        projections.with_time_parts(_orders(spark, sf_dir), "o_orderdate")
        .groupBy("o_orderpriority", "day_of_week").agg(F.count("*").alias("orders"))
    )
    return analytics.share_of_total(counts, "orders", ["day_of_week"])


@query
def orders_zscore_daily(spark, sf_dir):
    daily = timeseries.bucket_counts(_orders(spark, sf_dir), "o_orderdate", "1 day", fill=False)
    return anomaly.zscore_anomalies(daily, "event_count", threshold=2.0)


@query
def orders_rolling_week(spark, sf_dir):
    by = ["o_orderpriority"]
    daily = timeseries.bucket_counts(_orders(spark, sf_dir), "o_orderdate", "1 day", by)
    return timeseries.trailing_mean(
        daily, ["bucket"], "event_count", 7, by, "1 day", "rolling_week"
    )


@query
def freshness_from_footers(spark, sf_dir):
    return monitoring.freshness_from_footers(
        spark, {"events": (A.table_path(sf_dir, "events"), "ts"), "orders": (A.table_path(sf_dir, "orders"), "o_orderdate")}
    )


# -- streams -------------------------------------------------------------------------------------


@query
def stream_file_source(spark, sf_dir):
    out = run_dir(spark, "stream_file_source")
    _run(
        readers.decode_json(A.raw_messages(_stream(spark, sf_dir)), SYMPTOM_REPORT),
        sinks.append_sink(out), "stream_file_source",
    )
    return sinks.read_history(spark, out).select(
        "event_id", "event_type", "timestamp", "patient_id", "symptoms"
    )


@query
def stream_symptom_by_region(spark, sf_dir):
    out = run_dir(spark, "stream_symptom_by_region")
    _run(
        analytics.symptom_by_region(A.symptom_reports(_stream(spark, sf_dir))),
        sinks.snapshot_sink(out, 1_000_000), "stream_symptom_by_region", mode="complete",
    )
    return sinks.read_snapshot(spark, out)


@query
def stream_dq(spark, sf_dir):
    out = run_dir(spark, "stream_dq")
    streams.start_dq_stream(
        A.dq_events(_stream(spark, sf_dir)), sinks.append_sink(out), "stream_dq",
        run_dir(spark, "stream_dq-checkpoint"), trigger="availableNow",
    ).awaitTermination()
    history = sinks.read_history(spark, out)
    return history.agg(
        *[F.sum(c).alias(c) for c in history.columns if c not in ("timestamp", "batch_id")]
    )


def _env_stream(spark, sf_dir, name):
    """One table of the environment job over what the stream has now."""
    out = run_dir(spark, f"stream_{name}")
    for started in jobs.start_environment_job(
        A.environmental_conditions(_stream(spark, sf_dir)), {name: sinks.snapshot_sink(out, 1_000_000)},
        run_dir(spark, f"stream_{name}-checkpoint"), trigger="availableNow",
        state_partitions=spark.sparkContext.defaultParallelism,
    ):
        started.awaitTermination()
    return sinks.read_snapshot(spark, out).drop("last_updated")


@query
def stream_env_avg_temp(spark, sf_dir):
    return _env_stream(spark, sf_dir, "env_avg_temp")


@query
def stream_env_air_quality(spark, sf_dir):
    return _env_stream(spark, sf_dir, "env_aqi_distribution")


@query
def stream_env_hourly(spark, sf_dir):
    return _env_stream(spark, sf_dir, "env_hourly_temp")


def _hourly_stream(spark, sf_dir, name):
    """Counts per hour and region, each window's newest count once the stream has ended."""
    out = run_dir(spark, name)
    _run(
        streams.windowed_stream(
            A.symptom_reports(_stream(spark, sf_dir)), T, "1 hour", ["region"], "10 minutes"
        ),
        sinks.append_sink(out, 1_000_000), name, mode="update",
    )
    return sinks.read_latest(spark, out, ["window_start", "window_end", "region"])


@query
def stream_windowed_counts(spark, sf_dir):
    return _hourly_stream(spark, sf_dir, "stream_windowed_counts")


@query
def stream_sliding_counts(spark, sf_dir):
    hourly = _hourly_stream(spark, sf_dir, "stream_sliding_counts")
    return timeseries.sliding_counts(
        hourly, "window_start", "6 hours", "1 hour", ["region"], "event_count", every_slide=True
    )


@query
def stream_dedup(spark, sf_dir):
    out = run_dir(spark, "stream_dedup")
    events = A.symptom_reports(_stream(spark, sf_dir)).select("event_id", T, "symptoms")
    _run(
        streams.dedup_stream(events.unionByName(events), "event_id", T),
        sinks.append_sink(out), "stream_dedup",
    )
    return sinks.read_history(spark, out).drop("batch_id")


@query
def stream_cooldown(spark, sf_dir):
    source, out = run_dir(spark, "alerts"), run_dir(spark, "stream_cooldown")
    found = alert_volume(spark, sf_dir).select("region", "window_end", "event_count")
    found.write.parquet(source)
    arriving = readers.read_event_stream(spark, "parquet", {}, found.schema, source)
    _run(
        streams.cooldown_stream(arriving, "window_end", ["region"], 360),
        sinks.append_sink(out), "stream_cooldown",
    )
    return sinks.read_history(spark, out).drop("batch_id")


# -- streams that are stopped and resumed --------------------------------------------------------


def _in_turns(spark, name, parts, start):
    """Deliver parts of a table one after the other; the queries are resumed from their checkpoints for each."""
    source = run_dir(spark, f"{name}-source")
    for part in parts:
        part.write.mode("append").parquet(source)
        for started in start(source):
            started.awaitTermination()


def _with_late_rows(spark, sf_dir):
    """The events in three deliveries: the first half in time without some early events; these, behind the
    watermark by then, with the second half; and a closing event of each kind a month later."""
    events = A.events(spark, sf_dir)
    low, high = events.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    at, half, quarter = F.unix_micros("ts"), low + (high - low) // 2, low + (high - low) // 4
    late = (F.col("event_id") % 50 == 7) & (at < quarter)
    closing = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.timestamp_micros(F.lit(high + 30 * 86_400_000_000)).alias("ts"),
        F.lit(0).cast("bigint").alias("user_id"), F.explode(F.array(F.lit("click"), F.lit("error"))).alias("event_type"),
        F.lit(0.0).alias("value"), F.lit("{}").alias("props"),
    )
    return [events.where((at < half) & ~late), events.where((at >= half) | late), closing]


def _events_under(spark, source):
    return readers.read_event_stream(spark, "parquet", {}, A.EVENTS_SCHEMA, source)


def _reports(events):
    return A.symptom_reports(events.where(F.col("event_type").isin("click", "view"))).select("event_id", T, "region", "severity")


def _readings(events):
    return A.environmental_conditions(events.where("event_type = 'error'")).select(
        "region", F.col(T).alias("reading_time"), "temperature_f"
    )


#: Marks a column that is rounded already: a join that repeats its rows many times need not round them again.
ROUNDED = "rounded"


def _rounded_readings(events):
    rounded = (F.round("temperature_f", 6) + 0.0).alias("temperature_f", metadata={ROUNDED: True})
    return _readings(events).select("region", "reading_time", rounded)


@query
def range_join(spark, sf_dir):
    """Reports with the readings of their region of the half hour before."""
    events = A.events(spark, sf_dir)
    return matching.range_join(_reports(events), _rounded_readings(events), T, "reading_time", ["region"], "30 minutes")


@query
def stream_join(spark, sf_dir):
    out, root = run_dir(spark, "stream_join"), run_dir(spark, "stream_join-checkpoint")

    def start(source):
        reports, readings = _reports(_events_under(spark, source)), _rounded_readings(_events_under(spark, source))
        joined = streams.range_join_stream(reports, readings, T, "reading_time", ["region"], "30 minutes", packed=True)
        return [streams.start_stream(joined, sinks.append_sink(out), "stream_join", root, trigger="availableNow", state_partitions=tasks)]

    # a task for each core; the history holds packs, and the pairs come out of it, in more and smaller tasks
    tasks = max(4, spark.sparkContext.defaultParallelism)
    _in_turns(spark, "stream_join", _with_late_rows(spark, sf_dir), start)
    pairs = streams.open_packs(sinks.read_history(spark, out).drop("batch_id").repartition(4 * tasks))
    rounded = F.col("temperature_f").alias("temperature_f", metadata={ROUNDED: True})
    return pairs.where("event_id <> '-1'").withColumn("temperature_f", rounded)


@query
def session_region_counts(spark, sf_dir):
    return timeseries.session_counts(_symptoms(spark, sf_dir), T, "10 minutes", ["region"])


@query
def stream_sessions(spark, sf_dir):
    out, root = run_dir(spark, "stream_sessions"), run_dir(spark, "stream_sessions-checkpoint")

    def start(source):
        found = streams.session_stream(A.symptom_reports(_events_under(spark, source)), T, "10 minutes", ["region"])
        return [streams.start_stream(found, sinks.append_sink(out), "stream_sessions", root, trigger="availableNow", state_partitions=4)]

    _in_turns(spark, "stream_sessions", _with_late_rows(spark, sf_dir), start)
    return sinks.read_history(spark, out).drop("batch_id")


def _long(name, df, keys, value):
    """A table as (table_name, first_key, second_key, event_count, value) rows."""
    first, second = [*keys, None][:2]
    return df.select(
        F.lit(name).alias("table_name"), F.col(first).cast("string").alias("first_key"),
        (F.col(second) if second else F.lit(None)).cast("string").alias("second_key"),
        (F.col("event_count") if "event_count" in df.columns else F.lit(None)).cast("bigint").alias("event_count"),
        F.col(value).cast("double").alias("value"),
    )


def _halves(spark, sf_dir):
    return [A.events(spark, sf_dir).where(F.col("event_id") % 2 == i) for i in (0, 1)]


@query
def stream_symptom_rollups(spark, sf_dir):
    """All four tables of the symptom job from one query, resumed for the second half of the events."""
    root = run_dir(spark, "stream_symptom_rollups")
    tables = ("symptom_by_region", "severity_distribution", "temporal_patterns")
    sink = {name: sinks.snapshot_sink(f"{root}/{name}") for name in tables}
    sink["data_quality_metrics"] = sinks.append_sink(f"{root}/data_quality_metrics")

    def start(source):
        events = ingest.with_severity_score(A.symptom_reports(_events_under(spark, source)))
        return [jobs.start_symptom_rollups(events, sink, root, trigger="availableNow")]

    _in_turns(spark, "stream_symptom_rollups", _halves(spark, sf_dir), start)
    found = {name: sinks.read_snapshot(spark, f"{root}/{name}") for name in tables}
    history = sinks.read_history(spark, f"{root}/data_quality_metrics")
    failures = history.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("rule"), F.col("total_records").alias("event_count"), F.col(c).cast("bigint").alias("failures"))
                for c in ("region_null_fail", "region_allowed_fail", "dq_fail", "rows_with_any_failure")
            ])
        ).alias("x")
    ).select("x.*").groupBy("rule").agg(F.sum("event_count").alias("event_count"), F.sum("failures").alias("failures"))
    return reduce(
        DataFrame.unionByName,
        [
            _long("symptom_by_region", found["symptom_by_region"], ["region", "symptoms"], "avg_severity_score"),
            _long("severity_distribution", found["severity_distribution"], ["severity", "hour_of_day"], "percentage"),
            _long("temporal_patterns", found["temporal_patterns"], ["day_of_week", "hour_of_day"], "unique_patients"),
            _long("data_quality_metrics", failures, ["rule"], "failures"),
        ],
    )


@query
def stream_environment_rollups(spark, sf_dir):
    root = run_dir(spark, "stream_environment_rollups")
    tables = ("env_avg_temp", "env_aqi_distribution", "env_hourly_temp")
    sink = {name: sinks.snapshot_sink(f"{root}/{name}") for name in tables}

    def start(source):
        events = A.environmental_conditions(_events_under(spark, source))
        return [jobs.start_environment_rollups(events, sink, root, trigger="availableNow")]

    _in_turns(spark, "stream_environment_rollups", _halves(spark, sf_dir), start)
    found = {name: sinks.read_snapshot(spark, f"{root}/{name}").drop("last_updated") for name in tables}
    return reduce(
        DataFrame.unionByName,
        [
            # means of readings with few digits lie on the edge of rounding; both engines are nudged off it
            _long(name, df, [df.columns[0], None], value).withColumn("second_key", F.lit(value))
            .withColumn("value", F.col("value") + 1e-9)
            for name, df in found.items() for value in df.columns[1:]
        ],
    )


@query
def stream_cooldown_any_order(spark, sf_dir):
    """Alerts that come up to half a day late, in three deliveries; the closing one settles the rest."""
    out, root = run_dir(spark, "stream_cooldown_any_order"), run_dir(spark, "stream_cooldown_any_order-checkpoint")
    found = sinks.feature_table(
        alert_volume(spark, sf_dir).select("region", "window_end", "event_count"), "volume_alerts"
    )
    low, high = found.agg(F.unix_seconds(F.min("window_end")), F.unix_seconds(F.max("window_end"))).first()
    arrives = F.unix_seconds("window_end") + F.pmod(F.xxhash64("region", "window_end"), F.lit(43200))
    half = 0 if low is None else low + (high - low) // 2
    closing = spark.range(1).select(
        F.lit("closing").alias("region"), F.timestamp_seconds(F.lit((high or 0) + 30 * 86400)).alias("window_end"),
        F.lit(0).cast("bigint").alias("event_count"),
    )

    def start(source):
        arriving = readers.read_event_stream(spark, "parquet", {}, found.schema, source)
        fired = streams.settled_cooldown_stream(arriving, "window_end", ["region"], 360, "24 hours")
        return [streams.start_stream(fired, sinks.append_sink(out), "stream_cooldown_any_order", root, trigger="availableNow", state_partitions=4)]

    _in_turns(spark, "stream_cooldown_any_order", [found.where(arrives < half), found.where(arrives >= half), closing], start)
    return sinks.read_history(spark, out).where("region <> 'closing'").drop("batch_id")


@query
def stream_by_interval(spark, sf_dir):
    """A query on a processing-time trigger, stopped once it has read all there is."""
    out = run_dir(spark, "stream_by_interval")
    started = streams.start_stream(
        A.symptom_reports(_stream(spark, sf_dir)).select("event_id", "region", "severity"), sinks.append_sink(out),
        "stream_by_interval", run_dir(spark, "stream_by_interval-checkpoint"), trigger="1 second",
    )
    try:
        started.processAllAvailable()
    finally:
        started.stop()
    return sinks.read_history(spark, out).drop("batch_id")


@query
def stamp_as_of(spark, sf_dir):
    """The region table, stamped with the time that the caller gives."""
    by_region = analytics.symptom_by_region(_symptoms(spark, sf_dir)).select("region", "symptoms", "event_count")
    return projections.stamp(by_region, last_updated=F.lit("2024-03-01 12:00:00").cast("timestamp"))
