"""Properties every physical plan must keep, whatever the size of the tables."""

import os

import pytest

from signalwatch.plans.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.01"
EAGER = {
    "forecast_linear2", "forecast_linear5", "forecast_predictions", "forecast_random_forest",
    "forecast_gbt", "model_comparison", "models_against_mean",
}
LAZY = [n for n in sorted(REGISTRY) if n not in EAGER and not n.startswith("stream")]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def _plan(spark, name, run=False):
    execution = REGISTRY[name](spark, SF_DIR)._jdf.queryExecution()
    if run:
        execution.toRdd().count()
    return execution.executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, name):
    plan = _plan(spark, name)
    for operator in ("NestedLoopJoin", "CartesianProduct", "EvalPython", "PandasGroup", "MapIn"):
        assert operator not in plan


def _scans(plan):
    """Scans of the given tables in an executed plan, those of subqueries included; what an earlier step has
    stored is no such table, and a reused exchange scans nothing."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _scans(plan.executedPlan())
    if kind.startswith("Reused"):
        return 0
    if kind.endswith("QueryStageExec"):
        return _scans(plan.plan())
    below = [plan.children(), plan.subqueries()]
    own = int(kind in ("FileSourceScanExec", "BatchScanExec") and SF_DIR in plan.simpleString(10_000))
    return own + sum(_scans(seq.apply(i)) for seq in below for i in range(seq.size()))


# Queries that read the events once per table they join or compare.
SEVERAL = {
    # reports and readings are two views of the events
    "range_join": 2,
    "alert_multi_metric": 2, "table_freshness": 3, "anomaly_overlay": 2, "enrich_events": 3, "forecast_metrics": 2,
    # the newest time is looked up first, from the time column alone
    "lookback_region_events": 2, "lookback_severity_share": 2,
}


@pytest.mark.parametrize("name", LAZY)
def test_a_query_reads_its_table_once(spark, name):
    execution = REGISTRY[name](spark, SF_DIR)._jdf.queryExecution()
    execution.toRdd().count()
    found = _scans(execution.executedPlan())
    print(name, found)
    assert found <= SEVERAL.get(name, 1)


def test_scans_read_only_the_needed_columns(spark):
    plan = _plan(spark, "symptom_by_region")
    assert "props" not in plan.split("ReadSchema:")[1]
    assert "value" not in _plan(spark, "tumbling_region_counts").split("ReadSchema:")[1]


def test_newest_time_reaches_the_scan(spark):
    scans = _plan(spark, "lookback_region_events").split("PushedFilters: [")[1:]
    assert any("GreaterThanOrEqual(ts" in scan.split("]")[0] for scan in scans)


def test_aggregates_combine_before_the_shuffle(spark):
    for name in ("symptom_by_region", "temporal_patterns", "dq_metrics", "sliding_region_counts"):
        assert "partial_count" in _plan(spark, name)


def test_top_k_is_taken_per_partition_first(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "top10_regions")
    assert "WindowGroupLimit" in _plan(spark, "alert_top_regions")


def test_freshness_comes_from_footers(spark, tmp_path):
    from signalwatch.operators import monitoring
    from signalwatch.session import session_conf

    table = spark.createDataFrame(
        [("a", "2024-01-01 00:00:01.5", "2024-02-01", 3), ("b", "2024-03-01 12:00:00", "2024-01-01", 1), (None, None, None, None)],
        "k string, t string, d string, n int",
    ).selectExpr("k", "cast(t as timestamp) as t", "cast(d as date) as d", "cast(t as timestamp_ntz) as z", "n")
    paths = {}
    for kind in ("TIMESTAMP_MICROS", "INT96"):
        paths[kind] = str(tmp_path / kind)
        with session_conf(spark, {"spark.sql.parquet.outputTimestampType": kind}):
            table.write.parquet(paths[kind])
    with session_conf(spark, monitoring.FOOTERS):
        for column in ("t", "d", "z"):
            plan = monitoring._pushed(spark, paths["TIMESTAMP_MICROS"], column)._jdf.queryExecution().executedPlan().toString()
            assert f"PushedAggregation: [MAX({column}), COUNT(*)]" in plan
    asked = {"t": (paths["TIMESTAMP_MICROS"], "t"), "d": (paths["TIMESTAMP_MICROS"], "d"), "z": (paths["INT96"], "z"), "old": (paths["INT96"], "t")}
    got = {r.table_name: (str(r.newest), r.row_count) for r in monitoring.freshness_from_footers(spark, asked).collect()}
    noon = ("2024-03-01 12:00:00", 3)
    assert got == {"t": noon, "d": ("2024-02-01 00:00:00", 3), "z": noon, "old": noon}
