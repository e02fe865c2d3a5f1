"""Writing results.

``foreachBatch`` may replay a batch after a failure, so every sink here gives the same table when the
same batch is written twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.session import run_dir, session_conf

BatchSink = Callable[[DataFrame, int], None]


def _folder(spark: SparkSession, path: str):
    """The file system and path object of a folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


# -- snapshots -----------------------------------------------------------------------------------


@contextmanager
def _in_files(df: DataFrame, rows_per_file: int | None) -> Iterator[DataFrame]:
    """Rows in files of about that many; adaptive execution does not merge a stream's partitions."""
    if rows_per_file is None:
        yield df
        return
    kept = df.persist()
    try:
        yield kept.repartition(max(1, -(-kept.count() // rows_per_file)))
    finally:
        kept.unpersist()


def snapshot_sink(
    path: str, rows_per_file: int | None = None, grace_seconds: int = 3600
) -> BatchSink:
    """Replace a table on each batch without a moment in which readers find it empty, stale or half
    written.

    Each batch is written to a folder of its own; a marker file that names the folder follows when it
    is complete, and readers read the folder of the newest marker only.  An empty batch is a snapshot
    too.  A replayed batch gets a folder and marker of its own.  Snapshots before the newest are kept for
    ``grace_seconds`` for readers that are still at them.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark, name = df.sparkSession, f"{batch_id:020d}-{uuid.uuid4().hex}"
        with _in_files(df, rows_per_file) as rows:
            rows.write.parquet(f"{path}/{name}")
        fs, marks = _folder(spark, f"{path}/_done")
        fs.mkdirs(marks)
        new = _folder(spark, f"{path}/_done/{name}")[1]
        fs.create(new, True).close()
        # by the file system's own clock
        now = fs.getFileStatus(new).getModificationTime()
        for mark in fs.listStatus(marks):
            old = mark.getPath().getName()
            if old < name and now - mark.getModificationTime() > grace_seconds * 1000:
                fs.delete(mark.getPath(), False)
                fs.delete(_folder(spark, f"{path}/{old}")[1], True)

    return write


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot written by ``snapshot_sink``."""
    fs, marks = _folder(spark, f"{path}/_done")
    names = [m.getPath().getName() for m in fs.listStatus(marks)] if fs.exists(marks) else []
    if not names:
        raise FileNotFoundError(f"no complete snapshot under {path}")
    return spark.read.parquet(f"{path}/{max(names)}")


def merge_batch(
    path: str, delta: DataFrame, batch_id: int, merge: Callable[[DataFrame], DataFrame], keep: int = 2
) -> DataFrame:
    """Merge a batch into the state table under ``path`` and return the new state.

    The state is the newest snapshot of an earlier batch with the batch's rows, merged; so a batch that is
    replayed, or written twice, gives the same state.  ``merge`` takes and returns rows of the table's
    schema.  Snapshots of the ``keep`` newest batches stay, for replays and for readers.
    """
    spark = delta.sparkSession
    fs, marks = _folder(spark, f"{path}/_done")
    names = sorted(m.getPath().getName() for m in fs.listStatus(marks)) if fs.exists(marks) else []
    earlier = [n for n in names if int(n.split("-")[0]) < batch_id]
    rows = delta
    if earlier:
        rows = spark.read.schema(delta.schema).parquet(f"{path}/{earlier[-1]}").unionByName(delta)
    name = f"{batch_id:020d}-{uuid.uuid4().hex}"
    merge(rows).write.parquet(f"{path}/{name}")
    fs.mkdirs(marks)
    fs.create(_folder(spark, f"{path}/_done/{name}")[1], True).close()
    kept = {f"{batch_id:020d}", *sorted({n.split("-")[0] for n in earlier})[-(keep - 1):]} if keep > 1 else {f"{batch_id:020d}"}
    for old in earlier:
        if old.split("-")[0] not in kept:
            fs.delete(_folder(spark, f"{path}/_done/{old}")[1], False)
            fs.delete(_folder(spark, f"{path}/{old}")[1], True)
    return spark.read.schema(delta.schema).parquet(f"{path}/{name}")


def jdbc_snapshot_sink(options: dict[str, str]) -> BatchSink:
    """Replace a database table on each batch, keeping its definition, indexes and grants."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.format("jdbc").options(**options).option("truncate", "true").mode(
            "overwrite"
        ).save()

    return write


def feature_table(df: DataFrame, name: str) -> DataFrame:
    """Write a feature table into the shared folder and read it back.

    For tables that several steps use: the events behind them are then read once, and a lost executor
    does not cause them to be read again.
    """
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- history -------------------------------------------------------------------------------------


def append_sink(path: str, rows_per_file: int | None = None) -> BatchSink:
    """Append each batch to a history table; a replayed batch replaces its own partition."""

    def write(df: DataFrame, batch_id: int) -> None:
        with _in_files(df, rows_per_file) as rows:
            rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def append_result(df: DataFrame, path: str, run_id: str) -> None:
    """Append the rows of one run to a result table; repeating the run does not duplicate them."""
    df.drop("run_id").write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All batches or runs of a history table, with ``batch_id`` / ``run_id`` as a column."""
    return spark.read.parquet(path)


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last state of each key in a history of changed rows, as update mode writes them."""
    history = read_history(spark, path)
    values = [c for c in history.columns if c not in (*keys, "batch_id")]
    last = history.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
    return last.select(*keys, *[F.col("_last")[c].alias(c) for c in values])


def append_to_table(df: DataFrame, table: str, run_id: str) -> None:
    """Append one run to a catalog table partitioned by ``run_id``, creating the table if needed."""
    spark = df.sparkSession
    rows = df.drop("run_id").withColumn("run_id", F.lit(run_id))
    if not spark.catalog.tableExists(table):
        rows.write.partitionBy("run_id").format("parquet").saveAsTable(table)
        return
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def append_to_jdbc(
    df: DataFrame, options: dict[str, str], id_col: str, id_value: object, keys: list[str]
) -> None:
    """Append one run to a database table, leaving out the rows an earlier attempt already wrote.

    ``keys`` identify a row within the run.  Only this run's keys are read back: the filter on
    ``id_col`` is pushed to the database.
    """
    written = (
        df.sparkSession.read.format("jdbc").options(**options).load()
        .where(F.col(id_col) == F.lit(id_value))
        .select(*[F.col(k).alias(f"_{k}") for k in keys])
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    missing = df.withColumn(id_col, F.lit(id_value)).join(written, same, "left_anti")
    missing.write.format("jdbc").options(**options).mode("append").save()


def jdbc_append_sink(options: dict[str, str], keys: list[str]) -> BatchSink:
    """``append_to_jdbc`` for streams, keyed by the batch number."""

    def write(df: DataFrame, batch_id: int) -> None:
        append_to_jdbc(df, options, "batch_id", batch_id, keys)

    return write


# -- typed topics and archives -------------------------------------------------------------------


def topic_payload(
    df: DataFrame, topics: dict[str, str], type_col: str = "event_type", key: str = "event_id"
) -> DataFrame:
    """Rows as broker messages: key, JSON value and the topic of the row's type.

    NULL fields are written out, so every message of a type has the same fields.  Rows of a type
    without a topic are left out; ``with_route`` keeps those for the quarantine.
    """
    topic = F.create_map(*[F.lit(x) for pair in topics.items() for x in pair])
    return (
        df.where(F.col(type_col).isin(*topics))
        .select(
            F.col(key).cast("string").alias("key"),
            F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"),
            topic[F.col(type_col)].alias("topic"),
        )
    )


def publish_by_type(
    df: DataFrame, options: dict[str, str], topics: dict[str, str], checkpoint: str | None = None,
    name: str | None = None, **columns,
):
    """Publish each row to the topic of its type, as a batch or as a named streaming query."""
    payload = topic_payload(df, topics, **columns)
    if not df.isStreaming:
        payload.write.format("kafka").options(**options).save()
        return None
    if not (checkpoint and name):
        raise ValueError("a streaming publish needs a name and a checkpoint")
    return (
        payload.writeStream.format("kafka").options(**options)
        .queryName(name).option("checkpointLocation", checkpoint).start()
    )


def archive_by_type(
    df: DataFrame, path: str, batch_id: int = 0, type_col: str = "event_type",
    rows_per_file: int | None = None,
) -> None:
    """Write events as JSON into one folder per type.

    Without ``rows_per_file`` there is no shuffle: each task writes its own rows and a file per type.  With it, rows are
    counted per type and dealt by type and a number, so that a batch writes no more files of a type than its rows need
    and a type holding most rows stays spread over tasks.  A repeated batch replaces the folders it
    wrote before and touches no others.
    """
    numbered = df.withColumn("batch_id", F.lit(batch_id))
    if rows_per_file is None:
        _archive(numbered, path, type_col)
        return
    kept = numbered.persist()
    try:
        files = F.ceil(F.count("*") / rows_per_file)
        sizes = kept.groupBy(type_col).agg(files.alias("_files")).withColumnRenamed(type_col, "_type")
        total = sizes.agg(F.sum("_files")).first()[0] or 1
        numbers = F.monotonically_increasing_id()
        dealt = kept.withColumn("_number", numbers).join(sizes, F.col(type_col).eqNullSafe(F.col("_type")))
        _archive(
            dealt.withColumn("_number", F.col("_number") % F.col("_files")).repartition(total, type_col, "_number")
            .drop("_number", "_files", "_type"),
            path, type_col,
        )
    finally:
        kept.unpersist()


def _archive(df: DataFrame, path: str, type_col: str) -> None:
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(type_col, "batch_id").json(path)
    )


def archive_sink(path: str, type_col: str = "event_type", rows_per_file: int | None = None) -> BatchSink:
    """``archive_by_type`` for streams."""
    return lambda df, batch_id: archive_by_type(df, path, batch_id, type_col, rows_per_file)
