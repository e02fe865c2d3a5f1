import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalwatch.operators import alerts

T0 = datetime(2024, 1, 1)
SCHEMA = "region string, window_start timestamp, window_end timestamp, event_count long"


def _windows(spark, counts, end=T0):
    return spark.createDataFrame(
        [(region, end - timedelta(minutes=5), end, n) for region, n in counts], SCHEMA
    )


def _alarms(spark, times, key="a"):
    return spark.createDataFrame([(key, t) for t in times], "k string, t timestamp")


def greedy(times, minutes):
    last, fired = None, []
    for t in sorted(set(times)):
        if last is None or t - last >= timedelta(minutes=minutes):
            last = t
            fired.append(t)
    return fired


def test_volume_threshold_is_inclusive(spark):
    windows = _windows(spark, [("NE", 500), ("NW", 499), (None, 900)])
    assert [r.region for r in alerts.volume_alerts(windows).collect()] == ["NE"]


def test_share_alert(spark):
    df = spark.createDataFrame(
        [(T0, s) for s in ["severe", "severe", "mild", "mild", "mild"]]
        + [(T0 + timedelta(days=1), "severe"), (T0 + timedelta(days=1), "mild"), (None, "severe")],
        "t timestamp, severity string",
    )
    got = alerts.share_alerts(df, "t", "1 day").collect()
    assert sorted((r.window_start, r.percentage) for r in got) == [
        (T0, 40.0), (T0 + timedelta(days=1), 50.0)
    ]


@pytest.mark.parametrize(
    "counts,level",
    [
        ([("a", 100)], "LOW"),
        ([("a", 100), ("b", 100)], "LOW"),
        ([("a", 100), ("b", 101)], "MEDIUM"),
        ([("a", 100), ("b", 100), ("c", 100), ("d", 200)], "HIGH"),
    ],
)
def test_levels(spark, counts, level):
    assert [r.level for r in alerts.alert_level(_windows(spark, counts)).collect()] == [level]


def test_no_hot_region_no_level(spark):
    assert alerts.alert_level(_windows(spark, [("a", 99), (None, 500)])).count() == 0


def test_top_regions_break_ties_by_name(spark):
    got = alerts.top_regions(_windows(spark, [("b", 5), ("a", 5), ("c", 9), ("d", 1)]), 2)
    assert [(r.rank, r.region) for r in got.orderBy("rank").collect()] == [(1, "c"), (2, "a")]


def _mix(spark, counts, end=T0):
    return spark.createDataFrame(
        [(s, end, n) for s, n in counts],
        "severity string, window_end timestamp, event_count long",
    )


def test_advanced_alert_text(spark):
    windows = _windows(spark, [("NE", 300), ("NW", 100), ("SE", 50)])
    found = alerts.advanced_alerts(windows, _mix(spark, [("mild", 3), ("severe", 1), (None, 4)]))
    row = alerts.format_alert(found).first()
    assert row.level == "MEDIUM" and row.hot_regions == 2
    assert row.message == "\n".join([
        "Symptom alert: more reports than usual",
        "Time: 2024-01-01T00:00:00+00:00",
        "Evaluated: 5 minutes, from 100 reports on",
        "Level: MEDIUM",
        "",
        "Regions above the threshold:",
        "- NE: 300 events (z=1.00)",
        "- NW: 100 events (z=-1.00)",
        "",
        "Shares by severity:",
        "- None: 50.0%",
        "- mild: 37.5%",
        "- severe: 12.5%",
    ])


def test_single_hot_region_has_no_score(spark):
    found = alerts.advanced_alerts(_windows(spark, [("NE", 300)]), _mix(spark, []))
    row = alerts.format_alert(found).first()
    assert row.level == "LOW" and "- NE: 300 events (z=nan)" in row.message
    assert row.message.endswith("Shares by severity: none known.")


def test_history_scores_a_region_against_its_own_past(spark):
    counts = [10, 12, 10, 12, 110]
    windows = spark.createDataFrame(
        [("NE", T0 + timedelta(minutes=m - 5), T0 + timedelta(minutes=m), n)
         for m, n in enumerate(counts)]
        + [("NW", T0 + timedelta(minutes=m - 5), T0 + timedelta(minutes=m), 150) for m in range(5)],
        SCHEMA,
    )
    got = alerts.alert_level(windows, history=("1 minute", 4)).orderBy("window_end").collect()
    assert [(r.hot_regions, r.level) for r in got] == [(1, "LOW")] * 4 + [(2, "HIGH")]
    assert [r.max_z for r in got] == [None] * 4 + [pytest.approx(99.0)]
    found = alerts.advanced_alerts(windows, _mix(spark, []), history=("1 minute", 4))
    last = found.orderBy("window_end").collect()[-1]
    assert [r.region for r in last.regions] == ["NW", "NE"]
    assert [r.z_score for r in last.regions] == [None, pytest.approx(99.0)]


def test_minimum_level(spark):
    windows, mix = _windows(spark, [("NE", 300)]), _mix(spark, [("mild", 1)])
    assert alerts.advanced_alerts(windows, mix, min_level="MEDIUM").count() == 0


def test_percentages_round_ties_to_even(spark):
    shares = spark.createDataFrame([(T0, 12.25), (T0, 12.75)], "window_end timestamp, percentage double")
    got = sorted(r.message.split("\n")[2] for r in alerts.format_share_alert(shares).collect())
    assert got == ["Severe: 12.2% of reports (threshold 40.0%)", "Severe: 12.8% of reports (threshold 40.0%)"]


def test_volume_message(spark):
    row = alerts.format_volume_alert(_windows(spark, [("b", 500), ("a", 700)])).first()
    assert row.message == "\n".join([
        "Volume alert: many reports", "Time: 2024-01-01T00:00:00+00:00",
        "Threshold: 500 reports in 5 minutes", "Regions:",
        "- a: 700 reports in 5 minutes", "- b: 500 reports in 5 minutes",
    ])


def test_multi_metric_needs_all(spark):
    a = spark.createDataFrame([(1, 5), (2, 5)], "w int, x int")
    b = spark.createDataFrame([(1, 1), (2, 9)], "w int, y int")
    got = alerts.multi_metric_alerts([a, b], ["w"], {"x": 5, "y": 2}).collect()
    assert [tuple(r) for r in got] == [(2, 5, 9)]


@pytest.mark.parametrize("seed,minutes,step,n", [
    (1, 10, 60, 500),          # one alert a minute for hours
    (2, 10, 7, 3000),          # a busy stream that never falls silent
    (3, 90, 3600, 400),        # sparse: most alerts fire
    (4, 3000, 3600, 400),      # a cooldown longer than a day
    (5, 1441, 86400, 60),      # a cooldown just longer than the gap
])
def test_cooldown_matches_a_greedy_walk(spark, seed, minutes, step, n):
    rng = random.Random(seed)
    times, t = [], T0 + timedelta(hours=20)
    for _ in range(n):
        t += timedelta(seconds=rng.randrange(1, 2 * step))
        times.append(t)
    times += rng.sample(times, 20)
    got = alerts.apply_cooldown(_alarms(spark, times), "t", ["k"], minutes)
    assert sorted({r.t for r in got.collect()}) == greedy(times, minutes)


def test_cooldown_over_midnight_and_silenced_days(spark):
    times = [T0 + timedelta(hours=h) for h in (0, 30, 47, 49, 71, 73, 97, 200)]
    for minutes in (60, 1440, 2880, 2940, 4320):
        got = alerts.apply_cooldown(_alarms(spark, times), "t", ["k"], minutes)
        assert sorted(r.t for r in got.collect()) == greedy(times, minutes)


def test_cooldown_keys_have_their_own_clocks(spark):
    times = [T0, T0 + timedelta(minutes=5), T0 + timedelta(minutes=10)]
    df = _alarms(spark, times, "a").unionByName(_alarms(spark, times[1:], None))
    own = alerts.apply_cooldown(df, "t", ["k"], 10).collect()
    assert sorted((str(r.k), r.t) for r in own) == [
        ("None", times[1]), ("a", times[0]), ("a", times[2])
    ]
    one = alerts.apply_cooldown(df, "t", [], 10).collect()
    assert sorted((str(r.k), r.t) for r in one) == [
        ("None", times[2]), ("a", times[0]), ("a", times[2])
    ]


def test_no_cooldown_lets_everything_through(spark):
    df = _alarms(spark, [T0, T0])
    assert alerts.apply_cooldown(df, "t", ["k"], 0).count() == 2


def test_cooldown_of_one_busy_key(spark):
    """Five blocks of a day, all of one clock: 20,000 alerts, every tenth fires."""
    df = spark.range(20000).select(F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") * 20).alias("t"))
    fired = alerts.apply_cooldown(df, "t", ["k"], 200 / 60)
    assert fired.count() == 2000
    assert fired.where(F.unix_seconds("t") % 200 != 0).isEmpty()
    plan = fired._jdf.queryExecution().executedPlan().toString()
    assert "collect_" not in plan and "SinglePartition" not in plan
