import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalwatch.operators import matching, timeseries
from signalwatch.sources import sinks
from signalwatch.streaming import streams

T0 = datetime(2024, 1, 1)


def _at(seconds):
    return None if seconds is None else T0 + timedelta(seconds=seconds)


def _left(spark, rows):
    return spark.createDataFrame([(i, k, _at(s)) for i, (k, s) in enumerate(rows)], "id int, k string, t timestamp")


def _right(spark, rows):
    return spark.createDataFrame([(k, _at(s), v) for k, s, v in rows], "k string, r timestamp, v int")


def _random(seed, n, keys=("a", "b", None)):
    draw = random.Random(seed)
    left = [(draw.choice(keys), draw.choice([None, *range(0, 400, 3)])) for _ in range(n)]
    right = [(draw.choice(keys), draw.choice([None, *range(0, 400, 3)]), draw.randrange(5)) for _ in range(n)]
    return left, right


@pytest.mark.parametrize(("before", "after"), [(30, 0), (7, 50), (0, 9)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_range_join_equals_a_double_loop(spark, rows, before, after, how):
    left, right = _random(before, 60)
    got = matching.range_join(
        _left(spark, left), _right(spark, right), "t", "r", ["k"], f"{before} seconds" if before else "1 second",
        f"{after} seconds" if after else None, how,
    )
    want = []
    for i, (k, s) in enumerate(left):
        met = [
            (i, k, _at(s), _at(x), v) for rk, x, v in right
            if k is not None and k == rk and s is not None and x is not None and s - max(before, 1) <= x <= s + after
        ]
        want += met or ([(i, k, _at(s), None, None)] if how == "left" else [])
    assert got.columns == ["id", "k", "t", "r", "v"]
    assert rows(got) == sorted(want, key=lambda r: [str(v) for v in r])


def test_range_join_spreads_a_hot_key_and_rejects_shared_names(spark):
    left = spark.range(4000).select(F.lit("a").alias("k"), F.timestamp_seconds("id").alias("t"))
    right = spark.range(4000).select(F.lit("a").alias("k"), F.timestamp_seconds("id").alias("r"))
    joined = matching.range_join(left, right, "t", "r", ["k"], "5 seconds")
    assert joined.count() == sum(min(i, 5) + 1 for i in range(4000))
    with pytest.raises(ValueError, match="both sides"):
        matching.range_join(left, right.withColumnRenamed("r", "T"), "t", "T", ["k"], "5 seconds")


def test_range_join_compares_few_rows_that_do_not_meet(spark):
    """No pair is compared by calendar arithmetic, small sides are dealt too, and most pairs of a block meet."""
    left = spark.range(100).select(F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") % 7200).alias("t"))
    right = spark.range(100).select(F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") % 7200).alias("r"))
    plan = matching.range_join(left, right, "t", "r", ["k"], "30 minutes")._jdf.queryExecution().sparkPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "SortMergeJoin" in join
    assert "INTERVAL" not in join
    assert "4.5E8" in plan  # blocks of a quarter of the range


def test_range_join_rounds_before_the_join(spark, tmp_path):
    import __spark_entry__
    from signalwatch.adapters import EVENTS_SCHEMA

    events = [(i, T0 + timedelta(minutes=i), 0, "error" if i % 2 else "view", -0.12345678 * i, "{}") for i in range(1, 9)]
    spark.createDataFrame(events, EVENTS_SCHEMA).write.parquet(str(tmp_path / "events.parquet"))
    joined = __spark_entry__.queries()["range_join"](spark, str(tmp_path))
    assert [round(v, 6) for (v,) in joined.where("event_id = '2'").select("temperature_f").collect()] == [-0.123457]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan[: plan.index("Join")]
    assert "round(" in plan
    assert joined.schema["temperature_f"].metadata == {}


@pytest.mark.parametrize(("block", "within"), [("10 seconds", None), ("1 day", None), ("100 seconds", 40)])
def test_asof_join_equals_a_walk(spark, rows, block, within):
    left, right = _random(3, 80)
    got = matching.asof_join(
        _left(spark, left), _right(spark, right), "t", "r", ["k"], block, f"{within} seconds" if within else None
    )
    want = []
    for i, (k, s) in enumerate(left):
        old = [(x, v) for rk, x, v in right if rk == k and s is not None and x is not None and x <= s]
        x, v = max(old, default=(None, None))
        if x is not None and within is not None and s - x > within:
            x, v = None, None
        want.append((i, k, _at(s), _at(x), v))
    assert rows(got) == sorted(want, key=lambda r: [str(v) for v in r])


@pytest.mark.parametrize(("gap", "block"), [("10 seconds", "20 seconds"), ("10 seconds", "1 day"), ("45 seconds", "1 second")])
def test_sessions_equal_session_windows(spark, rows, gap, block):
    """Also where events lie exactly a gap apart, on a block's edge, or in sessions over many blocks."""
    draw = random.Random(8)
    times = [(draw.choice(["a", "b", None]), draw.choice([None, *range(0, 200, 5), *range(1000, 3000)])) for _ in range(500)]
    times += [("c", s) for s in range(0, 600, 9)] + [("d", s) for s in range(0, 600, 10)]
    df = _left(spark, times)
    want = (
        df.where("t is not null").groupBy("k", F.session_window("t", gap).alias("s")).count()
        .select("k", "s.start", "s.end", "count")
    )
    assert rows(timeseries.session_counts(df, "t", gap, ["k"], block=block)) == rows(want)
    summed = timeseries.session_counts(df.withColumn("n", F.lit(2)), "t", gap, ["k"], "n", block)
    assert rows(summed.withColumn("event_count", F.col("event_count") / 2)) == rows(want)


def _deliver(spark, schema, root, parts, build):
    """Run a stream over each part in turn, resumed from its checkpoint, and return the last run."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(schema).parquet(f"{root}/in")
        query = streams.start_stream(
            build(source), sinks.append_sink(f"{root}/out"), "run", f"{root}/checkpoint", trigger="availableNow", state_partitions=2
        )
        query.awaitTermination()
    return query


def test_range_join_of_streams(spark, rows, tmp_path):
    """Two watermarks: unmatched rows come out, late ones don't, and at the end only the closing rows are held."""
    schema = "side string, id int, k string, t timestamp"
    row = lambda side, i, k, s: (side, i, k, _at(s))
    first = [row("l", 1, "a", 0), row("r", 9, "a", -30), row("l", 2, "b", 10), row("l", 3, None, 20), row("l", 4, "a", None), row("r", 8, "b", 3000), row("l", 5, "a", 3000)]
    second = [row("l", 6, "a", 100), row("r", 7, "a", 2980), row("r", 6, "a", -10), row("l", 7, "b", 3010)]
    closing = [row("l", -1, "z", 99999), row("r", -1, "z", 90000)]
    parts = [spark.createDataFrame(p, schema) for p in (first, second, closing)]

    def build(source):
        left = source.where("side = 'l'").select("id", "k", "t")
        right = source.where("side = 'r'").select("k", F.col("t").alias("r"), F.col("id").alias("v"))
        return streams.range_join_stream(left, right, "t", "r", ["k"], "60 seconds", lateness="5 minutes")

    query = _deliver(spark, schema, tmp_path, parts, build)
    got = rows(sinks.read_history(spark, str(tmp_path / "out")).select("id", "v"))
    # 6 and the reading 6 came behind the watermark; row 4 has no time
    assert got == sorted([(1, 9), (2, None), (3, None), (5, 7), (7, 8)], key=lambda r: [str(v) for v in r])
    assert sum(o.numRowsTotal for o in query.lastProgress.stateOperators) <= 3


def test_range_join_of_streams_keeps_a_block_in_a_row(spark, rows, tmp_path):
    """The state holds packs, not a row per event that every pair reads again; all pairs come out, once."""
    schema = "side string, id int, k string, t timestamp"
    dense = [(side, i, "a", _at(i % 50)) for side in "lr" for i in range(300)]
    closing = [("l", -1, "z", _at(99999)), ("r", -1, "z", _at(99999))]

    def build(source):
        left = source.where("side = 'l'").select("id", "k", "t")
        right = source.where("side = 'r'").select("k", F.col("t").alias("r"), F.col("id").alias("v"))
        return streams.range_join_stream(left, right, "t", "r", ["k"], "20 seconds", "10 seconds", lateness="5 minutes")

    query = _deliver(spark, schema, tmp_path, [spark.createDataFrame(dense, schema)], build)
    assert sum(o.numRowsTotal for o in query.lastProgress.stateOperators) < 20
    _deliver(spark, schema, tmp_path, [spark.createDataFrame(closing, schema)], build)
    got = rows(sinks.read_history(spark, str(tmp_path / "out")).select("id", "v"))
    want = [(i, j) for i in range(300) for j in range(300) if -20 <= j % 50 - i % 50 <= 10]
    assert got == sorted(want, key=lambda r: [str(v) for v in r])


@pytest.mark.parametrize(("after", "how"), [(None, "left"), ("10 seconds", "left"), ("10 seconds", "inner")])
def test_range_join_of_streams_in_packs(spark, rows, tmp_path, after, how):
    """The history holds a row per key and block, however many pairs come out of it; columns of any type are fine."""
    draw = random.Random(7)
    left = [(i, draw.choice(["a", "b", None]), draw.randrange(100)) for i in range(200)] + [(900, "c", 10), (901, "a", 5000)]
    right = [(i, draw.choice(["a", "b", None]), draw.randrange(0, 100, 3)) for i in range(200)]
    schema = "side string, id int, k string, t timestamp, tags map<string, int>, v double"
    events = [(side, i, k, _at(s), {"s": s}, i / 4 if i % 5 else None) for side, held in (("l", left), ("r", right)) for i, k, s in held]
    closing = [(side, -1, "z", _at(99999), None, None) for side in "lr"]

    def build(source):
        lefts = source.where("side = 'l'").select("id", "k", "t", "tags")
        rights = source.where("side = 'r'").select("k", F.col("t").alias("r"), F.col("id").alias("o"), F.col("tags").alias("notes"), "v")
        return streams.range_join_stream(lefts, rights, "t", "r", ["k"], "20 seconds", after, how, packed=True)

    _deliver(spark, schema, tmp_path, [spark.createDataFrame(p, schema) for p in (events, closing)], build)
    history = sinks.read_history(spark, str(tmp_path / "out"))
    assert history.count() < 30
    got = streams.open_packs(history.drop("batch_id"), how)
    assert got.columns == ["id", "k", "t", "tags", "r", "o", "notes", "v"]
    # left rows leave their pack outside generated code, which would hold all pairs of a pack
    outer = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate explode" in line and "_left" in line]
    assert outer and all("*(" not in line for line in outer if "transform(" in line)
    assert any("transform(" in line for line in outer)
    want, last = [], 10 if after else 0
    for i, k, s in left:
        met = [
            (i, k, _at(s), s, _at(x), o, x, o / 4 if o % 5 else None)
            for o, rk, x in right if k is not None and k == rk and s - 20 <= x <= s + last
        ]
        want += met or ([(i, k, _at(s), s, None, None, None, None)] if how == "left" else [])
    got = got.where("id >= 0").withColumn("tags", F.col("tags")["s"]).withColumn("notes", F.col("notes")["s"])
    assert rows(got) == sorted(want, key=lambda r: [str(v) for v in r])


def test_stream_join_writes_fewer_rows_than_pairs(spark, rows, tmp_path, monkeypatch):
    import __spark_entry__
    from signalwatch.adapters import EVENTS_SCHEMA

    written, append_sink = [], sinks.append_sink

    def watched(path, *args):
        written.append(path)
        return append_sink(path, *args)

    monkeypatch.setattr(sinks, "append_sink", watched)
    # a region's reports and readings within ten minutes, one report far later, none of those that are delivered late
    events = [(i, T0 + timedelta(seconds=3 * i), 4, "error" if i % 2 else "view", i + 0.12345678, "{}") for i in range(200) if i % 50 != 7]
    events += [(300, T0 + timedelta(days=4), 4, "view", 0.5, "{}")]
    spark.createDataFrame(events, EVENTS_SCHEMA).write.parquet(str(tmp_path / "events.parquet"))
    joined = __spark_entry__.queries()["stream_join"](spark, str(tmp_path))
    want = []
    for i in range(0, 200, 2):
        region = None if i % 97 == 0 else "XX" if i % 89 == 0 else "NE"
        met = [round(j + 0.123457, 6) for j in range(1, i, 2) if j % 50 != 7] if region == "NE" else []
        want += [(str(i), region, v) for v in met or [None]]
    want += [("300", "NE", None)]
    assert rows(joined, "event_id", "region", "temperature_f") == sorted(want, key=lambda r: [str(v) for v in r])
    assert sum(sinks.read_history(spark, path).count() for path in {*written}) < 20


def test_session_stream_merges_over_batches(spark, rows, tmp_path):
    schema = "k string, t timestamp"
    parts = [[("a", 0), ("a", 16), ("b", 5), ("a", None)], [("a", 8), ("b", 40), ("a", 300)], [("a", 3), ("z", 9999)]]
    frames = [spark.createDataFrame([(k, _at(s)) for k, s in p], schema) for p in parts]
    _deliver(spark, schema, tmp_path, frames, lambda df: streams.session_stream(df, "t", "10 seconds", ["k"], "1 minute"))
    got = rows(sinks.read_history(spark, str(tmp_path / "out")).drop("batch_id"))
    want = [("a", 0, 26, 3), ("b", 5, 15, 1), ("b", 40, 50, 1), ("a", 300, 310, 1)]
    assert got == sorted([(k, _at(s), _at(e), n) for k, s, e, n in want], key=lambda r: [str(v) for v in r])


@pytest.mark.parametrize("keys", [["k"], []])
def test_cooldown_stream_in_any_order(spark, rows, tmp_path, keys):
    from signalwatch.operators import alerts

    draw = random.Random(len(keys))
    schema = "t timestamp, k string, n int"
    found = [(draw.randrange(0, 40000), draw.choice(["x", "y", None]), i) for i in range(150)]
    found += [(s, k, i + 1000) for s, k, i in found[:20]]  # several alerts at one instant
    arriving = sorted(found, key=lambda r: r[0] + draw.uniform(0, 1500))
    cuts = [0, 60, 110, len(arriving)]
    parts = [[(_at(s), k, n) for s, k, n in arriving[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]
    parts.append([(_at(999999), "closing", -1)])
    build = lambda df: streams.settled_cooldown_stream(df, "t", keys, 20, "30 minutes")
    _deliver(spark, schema, tmp_path, [spark.createDataFrame(p, schema) for p in parts], build)
    got = rows(sinks.read_history(spark, str(tmp_path / "out")).where("n >= 0").drop("batch_id"))
    batch = spark.createDataFrame([(_at(s), k, n) for s, k, n in found], schema)
    assert got == rows(alerts.apply_cooldown(batch, "t", keys, 20))
