import json
import os

import pytest
from pyspark.sql import functions as F

from signalwatch.session import run_dir, session_conf, shared_dir
from signalwatch.sources import readers, sinks


def _df(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_snapshot_replaces_and_is_repeatable(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.snapshot_sink(path, grace_seconds=-1)
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, path)
    write(_df(spark, 1, 2), 0)
    assert rows(sinks.read_snapshot(spark, path)) == [(1,), (2,)]
    for batch, values in [(1, [3]), (2, [4, 5]), (2, [4, 5]), (10, [6])]:
        write(_df(spark, *values), batch)
        assert rows(sinks.read_snapshot(spark, path)) == [(v,) for v in values]
    assert len(os.listdir(f"{path}/_done")) <= 4


def test_an_empty_batch_empties_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.snapshot_sink(path, rows_per_file=10)
    write(_df(spark, 1, 2, 3), 0)
    write(_df(spark, 1).limit(0), 1)
    assert sinks.read_snapshot(spark, path).count() == 0


def test_a_reader_keeps_its_snapshot_during_later_writes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.snapshot_sink(path)
    write(_df(spark, 1), 0)
    reader = sinks.read_snapshot(spark, path)
    for batch in (1, 2, 3):
        write(_df(spark, 9), batch)
    assert rows(reader) == [(1,)]


def test_unfinished_snapshot_is_not_read(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.snapshot_sink(path)
    write(_df(spark, 1), 0)
    _df(spark, 2).write.parquet(f"{path}/{1:020d}-unfinished")
    assert rows(sinks.read_snapshot(spark, path)) == [(1,)]


def test_files_follow_the_rows(spark, tmp_path):
    for limit, files in ((None, None), (10, 1), (2, 3)):
        path = str(tmp_path / f"t{limit}")
        sinks.append_sink(path, limit)(_df(spark, *range(6)).repartition(6), 0)
        found = [f for f in os.listdir(f"{path}/batch_id=0") if f.endswith(".parquet")]
        assert files is None or len(found) == files


def test_latest_state_of_each_key(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.append_sink(path)
    for batch, changed in enumerate([[("a", 1), ("b", 1)], [("a", 3)], [("c", 2)]]):
        write(spark.createDataFrame(changed, "k string, n int"), batch)
    assert rows(sinks.read_latest(spark, path, ["k"]), "k", "n") == [("a", 3), ("b", 1), ("c", 2)]


def test_append_replay_does_not_duplicate(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.append_sink(path)
    for batch in (0, 1, 1):
        write(_df(spark, 7), batch)
    assert rows(sinks.read_history(spark, path), "batch_id", "v") == [(0, 7), (1, 7)]


def test_append_result(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for run, values in [("a", [1]), ("b", [2]), ("b", [2])]:
        sinks.append_result(_df(spark, *values), path, run)
    assert rows(sinks.read_history(spark, path), "run_id", "v") == [("a", 1), ("b", 2)]


def test_append_to_catalog_table(spark, rows):
    spark.sql("drop table if exists results")
    for run, values in [("a", [1]), ("b", [2, 3]), ("b", [2, 3])]:
        sinks.append_to_table(_df(spark, *values), "results", run)
    assert rows(spark.table("results"), "run_id", "v") == [("a", 1), ("b", 2), ("b", 3)]


def test_archive_by_type(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("x", 1), ("y", 2)], "event_type string, v int")
    for batch in (0, 0, 1):
        sinks.archive_by_type(df, path, batch)
    assert sorted(p for p in os.listdir(path) if "=" in p) == ["event_type=x", "event_type=y"]
    back = spark.read.schema("v int, event_type string, batch_id int").json(path)
    assert rows(back, "event_type", "batch_id", "v") == [
        ("x", 0, 1), ("x", 1, 1), ("y", 0, 2), ("y", 1, 2)
    ]


def test_payload_keeps_null_fields(spark):
    df = spark.createDataFrame(
        [("1", "a", None), ("2", "zzz", "NE")], "event_id string, event_type string, region string"
    )
    got = sinks.topic_payload(df, {"a": "topic-a"}).collect()
    assert [(r.key, r.topic) for r in got] == [("1", "topic-a")]
    assert json.loads(got[0].value) == {"event_id": "1", "event_type": "a", "region": None}


class _Recorder:
    """Stands in for a DataFrame reader or writer: remembers what it is told."""

    def __init__(self, frame=None):
        self.seen, self.frame = {}, frame

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **kw):
        self.seen.update(kw)
        return self

    def option(self, key, value):
        return self.options(**{key: value})

    def mode(self, name):
        return self.options(mode=name)

    def load(self, path=None):
        return self.frame

    def save(self):
        self.seen["saved"] = True


class _Session:
    def __init__(self, reader):
        self.read = self.readStream = reader


def test_jdbc_read_is_split_into_ranges():
    reader = _Recorder()
    options = readers.jdbc_options("jdbc:x", "t", "u", "p")
    readers.read_jdbc(_Session(reader), options, "id", (0, 100), 8)
    assert reader.seen["format"] == "jdbc" and reader.seen["dbtable"] == "t"
    assert (reader.seen["lowerBound"], reader.seen["numPartitions"]) == ("0", "8")
    with pytest.raises(ValueError):
        readers.read_jdbc(_Session(reader), options, "id")


def test_kafka_stream_options():
    reader = _Recorder()
    readers.read_event_stream(
        _Session(reader), "kafka", readers.kafka_options("b:1", "topic")
    )
    assert reader.seen == {
        "format": "kafka", "kafka.bootstrap.servers": "b:1", "subscribe": "topic",
        "startingOffsets": "earliest",
    }


def test_jdbc_snapshot_truncates():
    class Frame:
        write = _Recorder()

    sinks.jdbc_snapshot_sink({"url": "jdbc:x"})(Frame(), 3)
    assert Frame.write.seen == {
        "format": "jdbc", "url": "jdbc:x", "truncate": "true", "mode": "overwrite", "saved": True
    }


def test_publish_needs_a_checkpoint_on_streams(spark, tmp_path):
    stream = spark.readStream.schema("event_id string, event_type string").parquet(str(tmp_path))
    with pytest.raises(ValueError):
        sinks.publish_by_type(stream, {}, {"a": "b"})


def test_load_feature_prunes_and_filters(spark, tmp_path):
    path = str(tmp_path / "symptom_by_region")
    spark.createDataFrame(
        [("NE", "a", 1, 1.0, None, "x"), ("NW", "a", None, 1.0, None, "x")],
        "region string, symptoms string, event_count int, avg_severity_score double, "
        "last_updated timestamp, extra string",
    ).write.parquet(path)
    df = readers.load_feature(spark, path, required=["event_count"], fmt="parquet")
    assert df.count() == 1 and "extra" not in df.columns
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(event_count)" in plan


def test_shared_folder_comes_from_the_session(spark):
    assert run_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_cluster_without_shared_folder_is_an_error():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_local_session_without_shared_folder_uses_a_temporary_one():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "local[2]"

    assert shared_dir(Session()) == shared_dir(Session()) and os.path.isdir(shared_dir(Session()))


def test_session_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_conf(spark, {"spark.sql.shuffle.partitions": "99", "x.y": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "99"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("x.y", None) is None


def test_feature_table_round_trip(spark, rows):
    df = _df(spark, 1, 2).withColumn("w", F.lit("x"))
    assert rows(sinks.feature_table(df, "t")) == [(1, "x"), (2, "x")]
