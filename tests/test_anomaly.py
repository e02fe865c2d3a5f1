import math

import pytest

from signalwatch.operators import anomaly


def _df(spark, values, kind="int"):
    return spark.createDataFrame([(v,) for v in values], f"n {kind}")


def test_scores_use_the_population_deviation(spark):
    got = anomaly.with_zscore(_df(spark, [1, 2, 3, 4]), "n").orderBy("n").collect()
    std = math.sqrt(1.25)
    assert [r.z_score for r in got] == pytest.approx([-1.5 / std, -0.5 / std, 0.5 / std, 1.5 / std])


@pytest.mark.parametrize("values", [[], [5], [5, 5, 5], [None, None]])
def test_nothing_stands_out_when_nothing_varies(spark, values):
    assert anomaly.zscore_anomalies(_df(spark, values), "n").count() == 0


def test_threshold_is_inclusive_and_two_sided(spark):
    got = anomaly.zscore_anomalies(_df(spark, [-1, 1]), "n", threshold=1.0)
    assert sorted(r.n for r in got.collect()) == [-1, 1]


def test_nan_and_null_do_not_count(spark):
    values = [1.0, 3.0, None, float("nan")]
    got = anomaly.with_zscore(_df(spark, values, "double"), "n").collect()
    assert sorted(r.z_score for r in got if r.z_score is not None) == [-1.0, 1.0]
    assert anomaly.zscore_anomalies(_df(spark, values, "double"), "n", threshold=0.5).count() == 2


def test_scores_per_key_include_the_null_key(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 3), (None, 10), (None, 20), ("b", 7)], "k string, n int"
    )
    got = anomaly.with_zscore(df, "n", ["k"]).collect()
    assert sorted((str(r.k), r.n, r.z_score) for r in got) == [
        ("None", 10, -1.0), ("None", 20, 1.0), ("a", 1, -1.0), ("a", 3, 1.0), ("b", 7, None)
    ]
