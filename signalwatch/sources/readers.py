"""Reading events, tables and rule documents."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalwatch.schemas import TABLES


def kafka_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    """Options for one topic read from its beginning on the first start of a query."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **extra,
    }


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str = "org.postgresql.Driver"
) -> dict[str, str]:
    """Connection options; credentials always come from the caller and have no defaults."""
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def read_event_stream(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str],
    schema: StructType | str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Open a stream of events: a Kafka topic, or files when there is no broker."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def decode_json(
    df: DataFrame, schema: StructType | str, col: str = "value", keep: list[str] = ()
) -> DataFrame:
    """Turn a JSON payload column into typed columns, next to the envelope columns to ``keep``.

    Text that is no JSON object gives a row of NULLs, a field of the wrong type gives NULL in that
    field only; both stay in the data so that the quality checks can count them.
    """
    decoded = F.from_json(F.col(col).cast("string"), schema)
    return df.select(*keep, decoded.alias("_data")).select(*keep, "_data.*")


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Read a database table, in parallel ranges of ``partition_column`` where one is given."""
    reader = spark.read.format("jdbc").options(**options)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs the column's bounds")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def read_table(
    spark: SparkSession,
    name: str,
    options: dict[str, str] | None = None,
    fmt: str | None = None,
    schema: StructType | str | None = None,
    **ranges,
) -> DataFrame:
    """Read a table: by catalog name, from files (``fmt`` and a path as ``name``) or over JDBC.

    A database table is read by as many tasks as ``ranges`` give: ``partition_column``, ``bounds`` and
    ``partitions`` of ``read_jdbc``; without them by one.
    """
    options = options or {}
    if fmt == "jdbc":
        return read_jdbc(spark, {**options, "dbtable": name}, **ranges)
    if ranges:
        raise ValueError(f"only a database table is read in ranges: {sorted(ranges)}")
    if fmt is None:
        return spark.read.options(**options).table(name)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(name)


def select_feature(
    df: DataFrame, cols: list[str], required: list[str] = ()
) -> DataFrame:
    """Keep the listed columns of the rows whose required columns are set."""
    for name in required:
        df = df.where(F.col(name).isNotNull())
    return df.select(*cols)


def load_feature(
    spark: SparkSession,
    name: str,
    cols: list[str] | None = None,
    required: list[str] = (),
    **source,
) -> DataFrame:
    """Load a feature table by its column list; pruning and the filters reach the scan."""
    table = name.rstrip("/").split("/")[-1]
    return select_feature(read_table(spark, name, **source), cols or TABLES[table], required)


def load_rules(source: str | Path | dict) -> dict:
    """A rules or configuration document, given as a dict or as the path of a JSON file."""
    if isinstance(source, dict):
        return source
    return json.loads(Path(source).read_text(encoding="utf-8"))
