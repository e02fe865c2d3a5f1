import json
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException

from signalwatch.operators import alerts, analytics, quality
from signalwatch.sources import readers, sinks
from signalwatch.streaming import jobs, streams

T0 = datetime(2024, 1, 1)


def _message(i, minute, region="NE", severity="mild", patient="p1"):
    return json.dumps({
        "event_id": str(i), "event_type": "symptom_report",
        "timestamp": (T0 + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S.%f"),
        "patient_id": patient, "region": region, "symptoms": "cough", "severity": severity,
    })


def _files(spark, path, *batches):
    """One file per batch, so that each becomes a micro-batch of its own."""
    for batch in batches:
        df = spark.createDataFrame([(m,) for m in batch], "value string")
        df.coalesce(1).write.mode("append").parquet(str(path))


def _messages(spark, path):
    return readers.read_event_stream(
        spark, "parquet", {"maxFilesPerTrigger": "1"}, "value string", str(path)
    )


BATCHES = [
    [_message(1, 0), _message(2, 1, "NW", "severe", "p2"), "{bad"],
    [_message(3, 65, severity="critical"), _message(4, 70, None, "severe", None)],
    [_message(5, 130, "SE", "other", "p3")],
]


@pytest.fixture
def source(spark, tmp_path):
    path = tmp_path / "in"
    _files(spark, path, *BATCHES)
    return path


def _batch(spark, source):
    return jobs.decode_symptom_reports(spark.read.parquet(str(source)))


def test_symptom_job_equals_batch_and_resumes(spark, rows, source, tmp_path):
    names = ["symptom_by_region", "severity_distribution", "temporal_patterns"]
    out = {n: str(tmp_path / n) for n in names}
    table = {n: sinks.snapshot_sink(p) for n, p in out.items()}
    table["data_quality_metrics"] = sinks.append_sink(str(tmp_path / "dq"))
    rules = {"region": {"allowed": ["NE", "NW"]}}

    def run():
        started = jobs.start_symptom_job(
            jobs.decode_symptom_reports(_messages(spark, source)), table,
            str(tmp_path / "checkpoints"), rules, "availableNow", 2,
        )
        for q in started:
            q.awaitTermination()
        return {q.name: q for q in started}

    assert set(run()) == set(table)

    def check():
        df = _batch(spark, source)
        want = {
            "symptom_by_region": analytics.symptom_by_region(df),
            "severity_distribution": analytics.share_of_total(
                analytics.severity_by_hour(df), "event_count"
            ),
            "temporal_patterns": analytics.temporal_patterns(df, exact=True),
        }
        for name, frame in want.items():
            got = sinks.read_snapshot(spark, out[name])
            assert "last_updated" in got.columns
            assert rows(got, *frame.columns) == rows(frame)
        history = sinks.read_history(spark, str(tmp_path / "dq"))
        total = quality.run_dq(df, rules).first()
        assert history.agg({"total_records": "sum"}).first()[0] == total.total_records
        assert history.agg({"region_allowed_fail": "sum"}).first()[0] == total.region_allowed_fail
        return history.count()

    assert check() == 3
    run()  # nothing new: a restart must not count anything twice
    assert check() == 3
    _files(spark, source, [_message(6, 140, "SE")])
    run()
    assert check() == 4


def test_environment_job_equals_batch(spark, rows, tmp_path):
    messages = [
        json.dumps({
            "event_type": "environmental_conditions", "region": region, "temperature_f": temp,
            "timestamp": f"2024-01-01T0{i}:00:00.000000", "humidity_percent": 40 + i,
            "air_quality_index": 10 * i, "pollen_count": i, "uv_index": i, "wind_speed_mph": 1.5,
        })
        for i, (region, temp) in enumerate([("NE", 50.0), ("NE", 60.0), ("NW", 70.0)])
    ]
    source = tmp_path / "in"
    _files(spark, source, messages[:2], messages[2:])
    out = {n: str(tmp_path / n) for n in ("env_avg_temp", "env_aqi_distribution", "env_hourly_temp")}
    for q in jobs.start_environment_job(
        jobs.decode_environmental_conditions(_messages(spark, source)),
        {n: sinks.snapshot_sink(p) for n, p in out.items()}, str(tmp_path / "c"), "availableNow", 2,
    ):
        q.awaitTermination()
    df = jobs.decode_environmental_conditions(spark.read.parquet(str(source)))
    want = {
        "env_avg_temp": analytics.env_avg_temp(df),
        "env_aqi_distribution": analytics.env_air_quality(df),
        "env_hourly_temp": analytics.env_hourly(df),
    }
    for name, frame in want.items():
        assert rows(sinks.read_snapshot(spark, out[name]), *frame.columns) == rows(frame)


def test_await_any_stops_the_other_queries(spark, source, tmp_path):
    decoded = jobs.decode_symptom_reports(_messages(spark, source))
    running = [
        streams.start_stream(
            decoded, sinks.append_sink(str(tmp_path / name)), name, str(tmp_path / f"c-{name}"),
            trigger="1 second",
        )
        for name in ("first", "second")
    ]
    timer = threading.Timer(2, running[0].stop)
    timer.start()
    streams.await_any(spark, running)
    assert not any(q.isActive for q in running)


def test_await_any_raises_the_error_of_a_failed_query(spark, source, tmp_path):
    def broken(df, batch_id):
        raise RuntimeError("sink is gone")

    decoded = jobs.decode_symptom_reports(_messages(spark, source))
    query = streams.start_stream(decoded, broken, "broken", str(tmp_path / "c"), trigger=None)
    with pytest.raises(StreamingQueryException):
        streams.await_any(spark, [query])


def _run(df, path, name, tmp_path, **kw):
    streams.start_stream(
        df, sinks.append_sink(str(path)), name, str(tmp_path / f"c-{name}"),
        trigger="availableNow", state_partitions=2, **kw,
    ).awaitTermination()


def test_late_rows_are_left_out(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    _files(
        spark, source,
        [_message(1, 0), _message(2, 50)],
        [_message(3, 55)],
        [_message(4, 2), _message(5, 120)],    # minute 2 is older than 50 - 10
    )
    decoded = jobs.decode_symptom_reports(_messages(spark, source))
    _run(
        streams.windowed_stream(decoded, "event_timestamp", "5 minutes", ["region"], "10 minutes"),
        out, "windows", tmp_path,
    )
    got = sinks.read_history(spark, str(out)).collect()
    assert sorted(((r.window_start - T0).seconds // 60, r.event_count) for r in got) == [
        (0, 1), (50, 1), (55, 1)
    ]


def test_replays_are_dropped(spark, rows, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    _files(spark, source, [_message(1, 0), _message(1, 0)], [_message(1, 0), _message(2, 1)])
    decoded = jobs.decode_symptom_reports(_messages(spark, source))
    _run(streams.dedup_stream(decoded, "event_id", "event_timestamp"), out, "dedup", tmp_path)
    assert rows(sinks.read_history(spark, str(out)), "event_id") == [("1",), ("2",)]


def test_stream_cooldown_equals_batch(spark, rows, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    minutes = [0, 4, 9, 10, 11, 25, 26, 300, 305, 311]
    alarms = spark.createDataFrame(
        [(r, T0 + timedelta(minutes=m + d), m) for r, d in (("NE", 0), ("NW", 2)) for m in minutes],
        "region string, t timestamp, n int",
    )
    for hours in ("minute(t) < 10 and hour(t) = 0", "minute(t) >= 10 and hour(t) = 0", "hour(t) > 0"):
        alarms.where(hours).coalesce(1).write.mode("append").parquet(str(source))
    stream = readers.read_event_stream(
        spark, "parquet", {"maxFilesPerTrigger": "1"}, alarms.schema, str(source)
    )
    _run(streams.cooldown_stream(stream, "t", ["region"], 10), out, "cooldown", tmp_path)
    want = alerts.apply_cooldown(alarms, "t", ["region"], 10)
    assert rows(sinks.read_history(spark, str(out)), "region", "t") == rows(want, "region", "t")
    _run(streams.cooldown_stream(stream, "t", [], 10), tmp_path / "o2", "cooldown1", tmp_path)
    want = alerts.apply_cooldown(alarms, "t", [], 10)
    assert rows(sinks.read_history(spark, str(tmp_path / "o2")), "region", "t") == rows(
        want, "region", "t"
    )


def test_basic_alert_run(spark, source):
    got = jobs.run_basic_alerts(
        _batch(spark, source), minutes=100, volume=1, severe_share=30.0
    ).collect()
    texts = "\n".join(r.message for r in got)
    assert "- NE: 1 reports in 100 minutes" in texts
    assert "Severe: 33.3% of reports (threshold 30.0%)" in texts


def test_advanced_alert_run(spark, tmp_path):
    source = tmp_path / "in"
    _files(spark, source, [_message(i, i * 0.5, "NE") for i in range(60)]
           + [_message(100 + i, i, "NW") for i in range(30)])
    fired = jobs.run_advanced_alerts(
        _batch(spark, source), {"volume_threshold": 5, "cooldown_minutes": 10}
    ).orderBy("window_end").collect()
    times = [r.window_end for r in fired]
    assert len(times) >= 2
    assert all(b - a >= timedelta(minutes=10) for a, b in zip(times, times[1:]))
    assert all("from 5 reports on" in r.message for r in fired)


def test_anomaly_and_forecast_runs_append_once(spark, tmp_path):
    regions = spark.createDataFrame(
        [(f"r{i}", "x", 10) for i in range(20)] + [("hot", "x", 500)],
        "region string, symptoms string, event_count int",
    )
    path = str(tmp_path / "anomalies")
    for run in ("1", "1", "2"):
        jobs.run_anomalies(regions, path, run)
    got = sinks.read_history(spark, path).collect()
    assert sorted((r.region, str(r.run_id)) for r in got) == [("hot", "1"), ("hot", "2")]

    patterns = spark.createDataFrame(
        [(d, h, d + h, h) for d in range(1, 8) for h in range(24)],
        "day_of_week int, hour_of_day int, event_count int, unique_patients int",
    )
    path = str(tmp_path / "predictions")
    for _ in range(2):
        assert jobs.run_forecast(patterns, path, "r", "linear")
    assert sinks.read_history(spark, path).count() == 34
    assert not jobs.run_forecast(patterns.where("false"), path, "s", "linear")
