"""Tables kept up to date from small mergeable parts: rollups of streams, running moments, archives."""

import glob
import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from signalwatch.operators import alerts, analytics, anomaly, quality
from signalwatch.sources import sinks
from signalwatch.streaming import jobs

T0 = datetime(2024, 1, 1)
TABLES = ("symptom_by_region", "severity_distribution", "temporal_patterns")
RULES = {"region": {"allowed": ["NE", "NW"]}}


def _message(i):
    draw = random.Random(i)
    when = T0 + timedelta(minutes=draw.randrange(20000))
    return json.dumps({
        "event_id": str(i), "event_type": "symptom_report", "timestamp": when.strftime("%Y-%m-%dT%H:%M:%S.%f"),
        "patient_id": draw.choice([None, "p1", "p2", "p3"]), "region": draw.choice(["NE", "NW", "XX", None]),
        "symptoms": draw.choice(["cough", "fever"]), "severity": draw.choice(["mild", "severe", "odd"]),
    })


def _deliver(spark, root, numbers, sink, extra=()):
    frame = spark.createDataFrame([(_message(i),) for i in numbers] + [(m,) for m in extra], "value string")
    frame.coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("value string").parquet(f"{root}/in")
    query = jobs.start_symptom_rollups(jobs.decode_symptom_reports(stream), sink, str(root), RULES, "availableNow")
    query.awaitTermination()
    return query


def _sinks(root):
    table = {name: sinks.snapshot_sink(f"{root}/{name}") for name in TABLES}
    return table | {"data_quality_metrics": sinks.append_sink(f"{root}/dq")}


def _equal_to_batch(spark, rows, root):
    batch = jobs.decode_symptom_reports(spark.read.parquet(f"{root}/in"))
    want = {
        "symptom_by_region": analytics.symptom_by_region(batch),
        "severity_distribution": analytics.share_of_total(analytics.severity_by_hour(batch), "event_count"),
        "temporal_patterns": analytics.temporal_patterns(batch),
    }
    for name, table in want.items():
        got = sinks.read_snapshot(spark, f"{root}/{name}")
        assert set(got.columns) == {*table.columns, "last_updated"}
        rounded = [F.round(c, 9).alias(c) if kind == "double" else F.col(c) for c, kind in table.dtypes]
        assert rows(got.select(*rounded)) == rows(table.select(*rounded)), name
    total = quality.run_dq(quality.schema_flags(batch, ["event_id", "event_type", "region", "timestamp"], "timestamp"), RULES).first()
    history = sinks.read_history(spark, f"{root}/dq")
    for name in ("total_records", "region_allowed_fail", "schema_fail", "event_time_fail", "rows_with_any_failure", "dq_fail"):
        assert history.agg(F.sum(name)).first()[0] == total[name], name


def test_rollups_equal_batch_over_resumed_runs(spark, rows, tmp_path):
    sink = _sinks(tmp_path)
    _deliver(spark, tmp_path, range(40), sink, ["{bad", json.dumps({"event_id": "x", "timestamp": "yesterday"})])
    _equal_to_batch(spark, rows, tmp_path)
    query = _deliver(spark, tmp_path, range(40, 90), sink)
    _equal_to_batch(spark, rows, tmp_path)
    # one source, read once: no table starts a query or a scan of its own
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [50]
    assert len(query.lastProgress.sources) == 1
    _deliver(spark, tmp_path, [], sink)
    _equal_to_batch(spark, rows, tmp_path)


def test_a_replayed_batch_changes_nothing(spark, rows, tmp_path):
    broken = _sinks(tmp_path)
    write, failing = broken["temporal_patterns"], [True]

    def once_broken(df, batch_id):
        if failing and failing.pop():
            raise OSError("disk is full")
        write(df, batch_id)

    broken["temporal_patterns"] = once_broken
    with pytest.raises(StreamingQueryException):
        _deliver(spark, tmp_path, range(30), broken)
    # the state of the batch is stored already, then the batch comes again
    _deliver(spark, tmp_path, range(30, 35), broken)
    _equal_to_batch(spark, rows, tmp_path)


def test_merged_state_keeps_the_batches_it_needs(spark, rows, tmp_path):
    path = str(tmp_path / "state")
    merge = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    delta = lambda *pairs: spark.createDataFrame(pairs, "k string, n long")
    for batch, part in enumerate([delta(("a", 1)), delta(("a", 2), ("b", 1)), delta(("b", 5))]):
        for _ in range(2):
            state = sinks.merge_batch(path, part, batch, merge)
    assert rows(state) == rows(sinks.read_snapshot(spark, path)) == [("a", 3), ("b", 6)]
    kept = {name.split("/")[-1].split("-")[0] for name in glob.glob(f"{path}/_done/*")}
    assert kept == {f"{1:020d}", f"{2:020d}"}


def test_environment_rollups_equal_batch(spark, rows, tmp_path):
    readings = [
        (f"2024-01-01 0{i % 5}:30:00", "NE" if i % 3 else None, 50.5 + i, 40 + i, i, None if i % 2 else i, 2, 1.25 * i) for i in range(20)
    ]
    schema = (
        "t string, region string, temperature_f double, humidity_percent int, air_quality_index int, pollen_count int, "
        "uv_index int, wind_speed_mph double"
    )
    spark.createDataFrame(readings, schema).withColumn("event_timestamp", F.col("t").cast("timestamp")).drop("t").repartition(3).write.parquet(f"{tmp_path}/in")
    batch = spark.read.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp_path}/in")
    sink = {name: sinks.snapshot_sink(f"{tmp_path}/{name}") for name in jobs.ENVIRONMENT_TABLES}
    jobs.start_environment_rollups(stream, sink, str(tmp_path), "availableNow").awaitTermination()
    want = {
        "env_avg_temp": analytics.env_avg_temp(batch), "env_aqi_distribution": analytics.env_air_quality(batch),
        "env_hourly_temp": analytics.env_hourly(batch),
    }
    for name, table in want.items():
        rounded = [F.round(c, 9).alias(c) if kind == "double" else F.col(c) for c, kind in table.dtypes]
        assert rows(sinks.read_snapshot(spark, f"{tmp_path}/{name}").select(*rounded)) == rows(table.select(*rounded))


def test_moments_merge_without_losing_digits(spark, tmp_path):
    draw = random.Random(2)
    values = [("ab"[i % 2], i % 7, 1e9 + draw.random()) for i in range(400)] + [("c", 0, 5.0), ("d", 0, math.nan), ("d", 1, None)]
    df = spark.createDataFrame(values, "k string, day int, x double")
    for by in (["k"], []):
        parts = anomaly.moments(df, "x", [*by, "day"])
        merged = {tuple(r[:-3]): r for r in anomaly.merge_moments(parts, by).collect()}
        whole = {tuple(r[:-3]): r for r in anomaly.moments(df, "x", by).collect()}
        assert set(merged) == set(whole)
        for key, row in whole.items():
            assert merged[key].n == row.n
            if row.n:
                assert merged[key].mean == pytest.approx(row.mean, rel=1e-12)
                assert merged[key].m2 == pytest.approx(row.m2, rel=1e-5, abs=1e-9)
    path = str(tmp_path / "moments")
    for day in [*range(7), 3]:  # day 3 comes twice
        known = anomaly.update_moments(df.where(F.col("day") == day), path, f"day{day}", "x", ["k"])
    got = {(r.k, r.x): r.z_score for r in anomaly.score_with_moments(df.where("k in ('a', 'c')"), "x", known, ["k"]).collect()}
    want = {(r.k, r.x): r.z_score for r in anomaly.with_zscore(df.where("k in ('a', 'c')"), "x", ["k"]).collect()}
    assert got[("c", 5.0)] is None and want[("c", 5.0)] is None
    assert all(got[key] == pytest.approx(z, rel=1e-5) for key, z in want.items() if z is not None)


def test_archive_writes_files_of_bounded_size(spark, tmp_path):
    df = spark.range(3000, numPartitions=6).select(
        F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 100 == 1, F.lit(None).cast("string")).otherwise("hot").alias("event_type"),
        F.col("id").alias("v"),
    )
    path = str(tmp_path / "archive")
    for batch in (0, 0, 1):
        sinks.archive_by_type(df, path, batch, rows_per_file=500)
    back = spark.read.schema("v long, event_type string, batch_id int").json(path)
    assert back.count() == 6000 and back.select("v", "batch_id").distinct().count() == 6000
    files = lambda kind, batch: glob.glob(f"{path}/event_type={kind}/batch_id={batch}/*.json")
    for batch in (0, 1):
        assert len(files("rare", batch)) == 1 and len(files("__HIVE_DEFAULT_PARTITION__", batch)) == 1
        assert 3 <= len(files("hot", batch)) <= 6
    sinks.archive_by_type(df.limit(0), path, 2, rows_per_file=500)


def test_metrics_evaluated_at_other_times(spark):
    day = lambda h: T0 + timedelta(hours=h)
    base = spark.createDataFrame([("a", day(24), 9.0), ("a", day(48), 9.0), ("b", day(24), 9.0), ("c", day(24), 1.0)], "k string, t timestamp, score double")
    quality_rows = spark.createDataFrame([("a", day(20), 50.0), ("a", day(25), 5.0), ("b", day(1), 80.0), ("c", day(24), 99.0)], "k string, at timestamp, rate double")
    volume = spark.createDataFrame([("a", day(24), 100), ("b", day(23), 100), ("c", day(2), 100)], "k string, seen timestamp, n int")
    fired = alerts.multi_metric_in_time(base, [(quality_rows, "at"), (volume, "seen")], "t", ["k"], {"score": 5, "rate": 20, "n": 50}, within="12 hours")
    assert [(r.k, r.t, r.at, r.seen) for r in fired.collect()] == [("a", day(24), day(20), day(24))]
