import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalwatch.operators import keyed, timeseries

T0 = datetime(2024, 1, 1)


def _minutes(spark, minutes, key=None):
    rows = [(key, T0 + timedelta(minutes=m)) for m in minutes]
    return spark.createDataFrame(rows, "k string, t timestamp")


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(keyed, "BLOCK", 8)


def test_filled_buckets_are_gapless(spark):
    df = _minutes(spark, [3, 4, 21], "a").unionByName(_minutes(spark, [7], "b"))
    df = df.unionByName(spark.createDataFrame([("a", None)], "k string, t timestamp"))
    got = timeseries.bucket_counts(df, "t", "5 minutes", ["k"]).orderBy("k", "bucket").collect()
    assert [(r.k, (r.bucket - T0).seconds // 60, r.event_count) for r in got] == [
        ("a", 0, 2), ("a", 5, 0), ("a", 10, 0), ("a", 15, 0), ("a", 20, 1), ("b", 5, 1)
    ]


def test_times_without_zone_work_too(spark):
    df = _minutes(spark, [3, 4, 21]).withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = timeseries.bucket_counts(df, "t", "5 minutes").orderBy("bucket").collect()
    assert [r.event_count for r in got] == [2, 0, 0, 0, 1]


def test_long_gap_is_filled(spark):
    df = _minutes(spark, [0, 5 * 10_000])
    got = timeseries.bucket_counts(df, "t", "5 minutes")
    assert got.count() == 10_001 and got.agg({"event_count": "sum"}).first()[0] == 2


def test_empty_table_gives_no_buckets(spark):
    assert timeseries.bucket_counts(_minutes(spark, []), "t", "5 minutes").count() == 0


@pytest.mark.parametrize("width,slide", [(5, 1), (60, 20), (30, 30)])
def test_sliding_counts_match_brute_force(spark, small_blocks, width, slide):
    rng = random.Random(width)
    minutes = [rng.randrange(600) for _ in range(300)] + [5000, 5001]
    got = timeseries.sliding_counts(
        _minutes(spark, minutes, "a"), "t", f"{width} minutes", f"{slide} minutes", ["k"]
    )
    want = {
        end: sum(end - width <= m < end for m in minutes)
        for end in {(m // slide + 1) * slide for m in minutes}
    }
    assert {
        int((r.window_end - T0).total_seconds() // 60): r.event_count for r in got.collect()
    } == want


@pytest.mark.parametrize("width,slide", [(5, 1), (60, 20), (30, 30)])
def test_quiet_slides_are_evaluated_while_events_are_in_reach(spark, small_blocks, width, slide):
    rng = random.Random(width)
    minutes = [rng.randrange(400) for _ in range(40)] + [5000, 5001, 5400]
    got = timeseries.sliding_counts(
        _minutes(spark, minutes, "a"), "t", f"{width} minutes", f"{slide} minutes", ["k"],
        every_slide=True,
    )
    want = {
        end: n for end in range(slide, 6000, slide)
        if (n := sum(end - width <= m < end for m in minutes))
    }
    assert {
        int((r.window_end - T0).total_seconds() // 60): r.event_count for r in got.collect()
    } == want


def test_sliding_width_must_fit(spark):
    with pytest.raises(ValueError):
        timeseries.sliding_counts(_minutes(spark, [1]), "t", "5 minutes", "2 minutes")


def _series(spark, n, drop=()):
    return spark.createDataFrame(
        [(k, i, float((i * 7 + len(k)) % 11)) for k in ("a", "bb") for i in range(n)
         if i not in drop],
        "k string, i int, v double",
    )


def test_row_numbers_have_no_gaps_across_chunks(spark, small_blocks):
    drop = {3, 4, 5, 40, 41, 42, 43, 44, 45, 46, 47, 48, 49, 50}
    got = keyed.number_places(_series(spark, 100, drop), ["i"], ["k"]).collect()
    kept = [i for i in range(100) if i not in drop]
    for key in ("a", "bb"):
        assert {r.i: r._pos for r in got if r.k == key} == {
            i: n for n, i in enumerate(kept, 1)
        }


def test_row_numbers_by_time(spark):
    df = _minutes(spark, range(0, 60 * 100, 37), "a")
    got = keyed.number_places(df, ["t"], ["k"]).orderBy("t").collect()
    assert [r._pos for r in got] == list(range(1, len(got) + 1))


def test_rows_share_their_place(spark):
    from signalwatch.operators import timeseries

    df = spark.createDataFrame(
        [("a", 0, 4.0), ("a", 0, 6.0), ("a", 1, 1.0), ("a", 2, 3.0), ("a", 5, 9.0)], "k string, i int, v double"
    )
    got = sorted((r.i, r._pos) for r in keyed.number_places(df, ["i"], ["k"]).collect())
    assert got == [(0, 1), (0, 1), (1, 2), (2, 3), (5, 4)]
    means = {r.i: r.m for r in timeseries.lagged_mean(df, ["i"], "v", 2, ["k"], name="m").collect()}
    assert means == {2: 11 / 3, 5: 2.0}
    hours = spark.createDataFrame(
        [(f"2024-01-01 0{h}:00:00", v) for h, v in ((0, 4.0), (0, 6.0), (1, 1.0), (2, 3.0))], "t string, v double"
    ).selectExpr("cast(t as timestamp) t", "v")
    late = {r.t.hour: r.m for r in timeseries.lagged_mean(hours, ["t"], "v", 2, width="1 hour", name="m").collect()}
    assert late == {2: 11 / 3}


def test_rows_of_fixed_domains_are_not_gathered(spark):
    from signalwatch.operators import timeseries

    events = spark.range(1000).selectExpr(
        "cast(id % 7 + 1 as int) day_of_week", "cast(id % 24 as int) hour_of_day", "cast(id as double) v"
    )
    order = ["day_of_week", "hour_of_day"]
    plan = timeseries.trailing_mean(events, order, "v", 3)._jdf.queryExecution().executedPlan().toString()
    # what remains without keys is one row per group of blocks
    assert plan.count("SinglePartition") <= 1 and "partial_sum" in plan


def test_row_numbers_need_an_orderable_lead(spark):
    with pytest.raises(ValueError):
        keyed.number_places(_series(spark, 3), ["k"])


def test_trailing_and_lagged_means_match_brute_force(spark, small_blocks):
    drop = {9, 10, 30}
    df = _series(spark, 60, drop)
    kept = [i for i in range(60) if i not in drop]
    trail = timeseries.trailing_mean(df, ["i"], "v", 5, ["k"]).collect()
    lag = timeseries.lagged_mean(df, ["i"], "v", 3, ["k"]).collect()
    for key in ("a", "bb"):
        v = [float((i * 7 + len(key)) % 11) for i in kept]
        want = {
            i: sum(v[max(0, n - 4):n + 1]) / len(v[max(0, n - 4):n + 1])
            for n, i in enumerate(kept)
        }
        assert {r.i: r.trailing_mean for r in trail if r.k == key} == pytest.approx(want)
        want = {i: sum(v[n - 3:n]) / 3 for n, i in enumerate(kept) if n >= 3}
        assert {r.i: r.lagged_mean for r in lag if r.k == key} == pytest.approx(want)


def test_lags(spark, small_blocks):
    got = timeseries.with_lags(_series(spark, 20), ["i"], "v", [1, 3], ["k"]).collect()
    values = {(r.k, r.i): r.v for r in got}
    for r in got:
        assert r.v_lag_1 == values.get((r.k, r.i - 1))
        assert r.v_lag_3 == values.get((r.k, r.i - 3))


def test_sustained_needs_a_full_run(spark):
    hot = [0, 1, 2, 3, 6, 7, 9, 10, 11]
    df = spark.createDataFrame(
        [("a", i, 10 if i in hot else 0) for i in range(13)], "k string, i int, v int"
    )
    got = timeseries.sustained(df, ["i"], "v", 10, 3, ["k"])
    assert sorted(r.i for r in got.collect()) == [2, 3, 11]


def test_sustained_buckets_break_at_a_gap(spark):
    df = spark.createDataFrame(
        [(T0 + timedelta(minutes=5 * i), 10) for i in (0, 1, 3, 4, 5)], "t timestamp, v int"
    )
    got = timeseries.sustained(df, ["t"], "v", 10, 3, width="5 minutes").collect()
    assert [r.t for r in got] == [T0 + timedelta(minutes=25)]


def test_rolling_sum_skips_missing_buckets(spark):
    df = spark.createDataFrame(
        [(T0 + timedelta(hours=h), 1) for h in (0, 1, 23, 24, 60)], "t timestamp, n int"
    )
    got = timeseries.rolling_sum(df, "t", "n", 24).orderBy("t").collect()
    assert [r.rolling_sum for r in got] == [1, 2, 3, 3, 1]


def test_history_score_leaves_the_bucket_itself_out(spark):
    df = spark.createDataFrame(
        [(T0 + timedelta(hours=h), v) for h, v in enumerate([1, 3, 1, 3, 10])],
        "t timestamp, n int",
    )
    got = timeseries.history_zscore(df, "t", "n", "1 hour", 4).orderBy("t").collect()
    assert got[0].z_score is None and got[1].z_score is None
    assert got[4].history_mean == 2 and got[4].z_score == 8.0


def test_baseline_ratio_of_zeros_is_null(spark):
    df = spark.createDataFrame(
        [(T0 + timedelta(hours=h), v) for h, v in enumerate([0, 0, 6])], "t timestamp, n int"
    )
    got = timeseries.baseline_ratio(df, "t", "n", "1 hour", 1, 3).orderBy("t").collect()
    assert [r.ratio for r in got] == [None, None, 3.0]


def test_overlay_marks_sit_above_the_series(spark):
    series = spark.createDataFrame([(1, 2.0), (2, 4.0)], "b int, v double")
    marks = spark.createDataFrame([(2,), (2,)], "b int")
    got = timeseries.anomaly_overlay(series, marks, "b", "v").orderBy("b").collect()
    assert [r.mark for r in got] == [None, pytest.approx(4.2)]


def test_frames_of_one_key_are_spread_over_blocks(spark, small_blocks):
    """A single hot series must not end in one window partition."""
    df = _minutes(spark, range(0, 5 * 200, 5), "a")
    series = timeseries.bucket_counts(df, "t", "5 minutes", fill=False)
    plan = timeseries.trailing_mean(
        series, ["bucket"], "event_count", 2, width="5 minutes"
    )._jdf.queryExecution().optimizedPlan().toString()
    assert "_block" in plan.split("Window [")[1].split("\n")[0]
