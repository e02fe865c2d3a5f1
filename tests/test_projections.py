import math
from datetime import datetime

from pyspark.sql import functions as F

from signalwatch.operators import analytics, projections


def test_time_parts_start_the_week_on_sunday(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 7, 23, 59),)], "event_timestamp timestamp")
    row = projections.with_time_parts(df).first()
    assert (row.day_of_week, row.hour_of_day) == (1, 23)


def test_cyclical(spark):
    df = spark.createDataFrame([(6,), (12,), (None,)], "hour_of_day int")
    six, noon, none = projections.with_cyclical(df).collect()
    assert math.isclose(six.hour_sin, 1) and math.isclose(noon.hour_cos, -1)
    assert none.hour_sin is None


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert [r.v for r in projections.coerce_numeric(df, ["v"]).collect()] == [1.5, None, None]


def test_lookback_defaults_to_newest_event(spark):
    times = [datetime(2024, 1, 1, 0, m) for m in (0, 4, 5, 10)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    assert projections.lookback(df, "t", 5).count() == 2
    assert projections.lookback(df, "t", 5, datetime(2024, 1, 1, 0, 9)).count() == 2


def test_lookback_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(datetime(2024, 1, 1), 1, "x")], "t timestamp, a int, b string") \
        .write.parquet(path)
    df = projections.lookback(spark.read.parquet(path), "t", 5, datetime(2024, 1, 1)).select("a")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t," in plan and "b:string" not in plan


def test_top_k_breaks_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3)], "k string, v int")
    assert [r.k for r in projections.top_k(df, "v", 2, ["k"]).collect()] == ["c", "a"]


def test_abs_error_and_stamp(spark):
    df = spark.createDataFrame([(1.0, 3.0)], "event_count_true double, event_count_pred double")
    row = projections.stamp(projections.with_abs_error(df), run_id="r", at=None).first()
    assert row.abs_error == 2.0 and row.run_id == "r" and row.at is not None


def test_shares_add_up(spark):
    df = spark.createDataFrame(
        [("a", 0, 1), ("b", 0, 3), (None, 1, 4), ("a", None, 2)], "s string, h int, n int"
    )
    whole = analytics.share_of_total(df, "n").collect()
    assert math.isclose(sum(r.percentage for r in whole), 100)
    within = analytics.share_of_total(df, "n", ["h"])
    sums = {r.h: r.p for r in within.groupBy("h").agg(F.sum("percentage").alias("p")).collect()}
    assert sums == {0: 100.0, 1: 100.0, None: 100.0}
    assert analytics.share_of_total(df.where("n > 9"), "n").count() == 0


def test_category_share_defaults_to_zero(spark):
    df = spark.createDataFrame([("mild",), (None,)], "severity string")
    assert analytics.category_share(df, "severity", "severe").first().percentage == 0.0
    assert analytics.category_share(df.where("false"), "severity", "severe").first()[0] == 0.0
    counted = spark.createDataFrame([("severe", 1), ("mild", 3)], "severity string, n int")
    assert analytics.category_share(counted, "severity", "severe", value="n").first()[0] == 25.0


def test_unique_patients_are_distinct(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 7), p) for p in ("x", "x", "y", None)],
        "event_timestamp timestamp, patient_id string",
    )
    for exact in (True, False):
        row = analytics.temporal_patterns(df, exact=exact).first()
        assert (row.event_count, row.unique_patients, row.patient_rows) == (4, 2, 3)


def test_pivot_fills_and_drops_null_rows(spark):
    df = spark.createDataFrame([("mild", 0, 2), (None, 1, 5)], "severity string, h int, n int")
    got = analytics.pivot_counts(df, "severity", "h", [0, 1], "n", "h").collect()
    assert [tuple(r) for r in got] == [("mild", 2, 0)]
