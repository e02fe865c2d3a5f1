"""Jobs: the streaming queries of each event type and the periodic batch runs.

A scheduler calls these; nothing here loops on a timer or holds state between calls.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalwatch.operators import alerts, analytics, anomaly, forecast, ingest, quality, timeseries
from signalwatch.operators.projections import stamp, with_time_parts
from signalwatch.operators.quality import DEFAULT_RULES
from signalwatch.schemas import ENVIRONMENTAL_CONDITIONS, SYMPTOM_REPORT
from signalwatch.sources.readers import decode_json
from signalwatch.sources.sinks import BatchSink, append_result, feature_table, merge_batch
from signalwatch.streaming.streams import TRIGGER, start_dq_stream, start_stream


def decode_symptom_reports(messages: DataFrame) -> DataFrame:
    decoded = ingest.with_event_time(decode_json(messages, SYMPTOM_REPORT))
    return ingest.with_severity_score(decoded)


def decode_environmental_conditions(messages: DataFrame) -> DataFrame:
    return ingest.with_event_time(decode_json(messages, ENVIRONMENTAL_CONDITIONS))


def _stamped(sink: BatchSink) -> BatchSink:
    return lambda df, batch_id: sink(stamp(df, last_updated=None), batch_id)


def _with_share(sink: BatchSink) -> BatchSink:
    """Shares use the batch twice, so it is kept: the state must not be worked out twice."""

    def write(df: DataFrame, batch_id: int) -> None:
        kept = df.persist()
        try:
            sink(analytics.share_of_total(kept, "event_count"), batch_id)
        finally:
            kept.unpersist()

    return write


def start_symptom_job(
    events: DataFrame, sinks: dict[str, BatchSink], checkpoint_root: str,
    rules: dict = DEFAULT_RULES, trigger: str | None = TRIGGER,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Start the three running aggregates and the quality checks of decoded symptom reports.

    ``sinks`` maps ``symptom_by_region``, ``severity_distribution``, ``temporal_patterns`` and
    ``data_quality_metrics`` to where they go; a table without a sink is not computed.  Shares need
    the finished batch, so they are added in the sink.
    """
    tables = {
        "symptom_by_region": (analytics.symptom_by_region, lambda s: s),
        "severity_distribution": (analytics.severity_by_hour, _with_share),
        "temporal_patterns": (
            lambda df: analytics.temporal_patterns(df, exact=False), lambda s: s
        ),
    }
    queries = [
        start_stream(
            aggregate(events), wrap(_stamped(sinks[name])), name, f"{checkpoint_root}/{name}",
            mode="complete", trigger=trigger, state_partitions=state_partitions,
        )
        for name, (aggregate, wrap) in tables.items() if name in sinks
    ]
    if "data_quality_metrics" in sinks:
        name = "data_quality_metrics"
        queries.append(
            start_dq_stream(
                events, sinks[name], name, f"{checkpoint_root}/{name}", rules, trigger,
                decoded=[c for c in ("event_id", "event_type", "region", "timestamp") if c in events.columns],
                text_time="timestamp" if {"timestamp", "event_timestamp"} <= set(events.columns) else None,
            )
        )
    return queries


def start_environment_job(
    events: DataFrame, sinks: dict[str, BatchSink], checkpoint_root: str,
    trigger: str | None = None, state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Start the three running aggregates of decoded environmental conditions."""
    tables = {
        "env_avg_temp": analytics.env_avg_temp,
        "env_aqi_distribution": analytics.env_air_quality,
        "env_hourly_temp": analytics.env_hourly,
    }
    return [
        start_stream(
            aggregate(events), _stamped(sinks[name]), name, f"{checkpoint_root}/{name}",
            mode="complete", trigger=trigger, state_partitions=state_partitions,
        )
        for name, aggregate in tables.items() if name in sinks
    ]


# -- one read for several tables -----------------------------------------------------------------

SYMPTOM_GRAIN = ["region", "symptoms", "severity", "day_of_week", "hour_of_day"]
ENVIRONMENT_GRAIN = ["region", "hour_of_day"]
ENVIRONMENT_READINGS = [
    "temperature_f", "humidity_percent", "air_quality_index", "pollen_count", "uv_index", "wind_speed_mph",
]


def symptom_grain(events: DataFrame, rules: dict = DEFAULT_RULES) -> DataFrame:
    """All that the four symptom tables need, at the finest of their grains, in one aggregation.

    Patients are a sketch, which merges; counts and failures of the quality rules are sums.
    """
    decoded = [c for c in ("event_id", "event_type", "region", "timestamp") if c in events.columns]
    text_time = "timestamp" if "timestamp" in events.columns else None
    checked = quality.validate(quality.schema_flags(events, decoded, text_time), rules)
    return (
        with_time_parts(checked, "event_timestamp").groupBy(*SYMPTOM_GRAIN)
        .agg(
            F.count("*").alias("event_count"), F.sum("severity_score").alias("severity_points"),
            F.count("patient_id").alias("patient_rows"), F.hll_sketch_agg("patient_id").alias("patients"),
            *[F.sum(c).alias(c) for c in [*quality.fail_columns(checked), "dq_fail"]],
            F.sum((F.col("dq_fail") > 0).cast("bigint")).alias("rows_with_any_failure"),
        )
    )


def environment_grain(events: DataFrame) -> DataFrame:
    """Sums and counts of the readings per region and hour of day; means come from these."""
    hourly = events.withColumn("hour_of_day", F.hour("event_timestamp"))
    return hourly.groupBy(*ENVIRONMENT_GRAIN).agg(
        F.count("*").alias("event_count"),
        *[F.sum(c).alias(f"{c}_sum") for c in ENVIRONMENT_READINGS],
        *[F.count(c).alias(f"{c}_rows") for c in ENVIRONMENT_READINGS],
    )


def merge_grain(rows: DataFrame, grain: list[str]) -> DataFrame:
    """Rows of a grain merged: sketches by union, everything else by sum."""
    merged = {
        c: F.hll_union_agg(c) if c == "patients" else F.sum(c) for c in rows.columns if c not in grain
    }
    return rows.groupBy(*grain).agg(*[value.alias(c) for c, value in merged.items()])


def _mean(name: str, column: str):
    return F.try_divide(F.sum(f"{column}_sum"), F.sum(f"{column}_rows")).alias(name)


SYMPTOM_TABLES = {
    "symptom_by_region": lambda state: state.groupBy("region", "symptoms").agg(
        F.sum("event_count").alias("event_count"),
        F.try_divide(F.sum("severity_points"), F.sum("event_count")).alias("avg_severity_score"),
    ),
    "severity_distribution": lambda state: analytics.share_of_total(
        state.groupBy("severity", "hour_of_day").agg(F.sum("event_count").alias("event_count")), "event_count"
    ),
    "temporal_patterns": lambda state: state.groupBy("day_of_week", "hour_of_day").agg(
        F.sum("event_count").alias("event_count"),
        F.hll_sketch_estimate(F.hll_union_agg("patients")).alias("unique_patients"),
        F.sum("patient_rows").alias("patient_rows"),
    ),
}
ENVIRONMENT_TABLES = {
    "env_avg_temp": lambda state: state.groupBy("region").agg(_mean("avg_temperature_f", "temperature_f")),
    "env_aqi_distribution": lambda state: state.groupBy("region").agg(
        _mean("avg_air_quality", "air_quality_index"), _mean("avg_pollen_count", "pollen_count"),
        _mean("avg_uv_index", "uv_index"),
    ),
    "env_hourly_temp": lambda state: state.groupBy("hour_of_day").agg(
        _mean("average_temp", "temperature_f"), _mean("average_humidity", "humidity_percent"),
        _mean("average_windspeed", "wind_speed_mph"),
    ),
}


def _batch_quality(delta: DataFrame) -> DataFrame:
    failures = [*quality.fail_columns(delta), "dq_fail"]
    return delta.agg(
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("total_records"),
        *[F.sum(c).alias(c) for c in [*failures, "rows_with_any_failure"]],
    ).withColumn("timestamp", F.current_timestamp())


def _start_rollups(
    events: DataFrame, name: str, grain, keys: list[str], tables: dict, sinks: dict[str, BatchSink], root: str,
    trigger: str | None, batch_tables: dict | None = None,
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        # the only use of the batch: everything below reads this small table
        delta = feature_table(grain(batch), f"{name}-delta")
        state = merge_batch(f"{root}/{name}-state", delta, batch_id, lambda rows: merge_grain(rows, keys))
        for table, rollup in tables.items():
            if table in sinks:
                sinks[table](stamp(rollup(state), last_updated=None), batch_id)
        for table, summary in (batch_tables or {}).items():
            if table in sinks:
                sinks[table](summary(delta), batch_id)

    return start_stream(events, write, name, f"{root}/{name}-checkpoint", trigger=trigger)


def start_symptom_rollups(
    events: DataFrame, sinks: dict[str, BatchSink], root: str, rules: dict = DEFAULT_RULES,
    trigger: str | None = TRIGGER, name: str = "symptom_rollups",
) -> StreamingQuery:
    """The tables of ``start_symptom_job`` from one read and one decode of the source.

    Each micro-batch is aggregated once, at the finest grain, and merged into a stored state table that all
    tables are rolled up from; a replayed batch starts from the state before it and changes nothing.
    The state has a row per combination of region, symptoms, severity, day and hour, not per event.
    """
    return _start_rollups(
        events, name, lambda batch: symptom_grain(batch, rules), SYMPTOM_GRAIN, SYMPTOM_TABLES, sinks, root,
        trigger, {"data_quality_metrics": _batch_quality},
    )


def start_environment_rollups(
    events: DataFrame, sinks: dict[str, BatchSink], root: str, trigger: str | None = None,
    name: str = "environment_rollups",
) -> StreamingQuery:
    """The tables of ``start_environment_job`` from one read of the source."""
    return _start_rollups(
        events, name, environment_grain, ENVIRONMENT_GRAIN, ENVIRONMENT_TABLES, sinks, root, trigger
    )


# -- periodic runs -------------------------------------------------------------------------------


def run_basic_alerts(
    events: DataFrame, t: str = "event_timestamp", as_of: datetime | None = None,
    minutes: int = 5, volume: int = alerts.VOLUME_THRESHOLD,
    severe_share: float = alerts.SEVERE_SHARE_THRESHOLD,
) -> DataFrame:
    """Messages of one evaluation: regions with many events and a high share of severe ones."""
    # one small table of counts, from one pass over the recent events, gives both kinds of alerts
    counts = feature_table(
        analytics.lookback(events, t, minutes, as_of).groupBy("region", "severity").agg(
            F.count("*").alias("event_count"), F.max(t).alias("newest")
        ),
        "recent_counts",
    )
    end = counts.agg(F.max("newest").alias("end")).select("end").scalar() if as_of is None else F.lit(as_of)
    regions = counts.groupBy("region").agg(F.sum("event_count").alias("event_count"))
    hot = alerts.volume_alerts(regions, volume).withColumn("window_end", end)
    share = analytics.category_share(counts, "severity", "severe", value="event_count")
    severe = share.where(F.col("percentage") >= severe_share).withColumn("window_end", end)
    return (
        alerts.format_volume_alert(hot, volume, minutes)
        .unionByName(
            alerts.format_share_alert(severe, severe_share, "window_end").select(
                "window_end", "message"
            )
        )
    )


def run_advanced_alerts(
    events: DataFrame, config: dict | None = None, t: str = "event_timestamp",
    min_level: str = "LOW", keys: list[str] = (),
) -> DataFrame:
    """All advanced alerts of a table of events, evaluated at every poll and after the cooldown.

    The events are read once, into stored counts per poll, region and severity.
    """
    config = {**alerts.ADVANCED_CONFIG, **(config or {})}
    width = f"{config['lookback_minutes']} minutes"
    slide = f"{config['poll_interval_seconds']} seconds"
    per_poll = feature_table(
        timeseries.bucket_counts(events, t, slide, ["region", "severity"], fill=False),
        "counts_per_poll",
    )
    fired = alerts.advanced_alerts(
        *[
            timeseries.sliding_counts(
                per_poll, "bucket", width, slide, [key], "event_count", every_slide=True
            )
            for key in ("region", "severity")
        ],
        config, min_level, cooldown_keys=list(keys),
    )
    return alerts.format_alert(fired, config)


def run_anomalies(
    by_region: DataFrame, path: str, run_id: str,
    threshold: float = anomaly.Z_THRESHOLD, detected_at: datetime | None = None,
) -> None:
    """Append the anomalies of the region table; repeating a run replaces its rows."""
    text = ingest.symptoms_as_text(by_region)
    found = anomaly.zscore_anomalies(text, "event_count", threshold=threshold)
    append_result(stamp(found, detected_at=detected_at), path, run_id)


def run_forecast(
    patterns: DataFrame, path: str, run_id: str, kind: str = "random_forest",
    features: list[str] = tuple(forecast.FEATURES_5), params: dict | None = None,
    predicted_at: datetime | None = None,
) -> bool:
    """Fit, score the held-out rows and append them; no usable rows write nothing."""
    train, test = forecast.split_by_key(forecast.forecast_features(patterns))
    model = forecast.fit_forecast(train, kind, list(features), params)
    if model is None:
        return False
    append_result(forecast.predictions(model, test, run_id, predicted_at), path, run_id)
    return True
