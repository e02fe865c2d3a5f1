"""The tables behind charts and dashboards."""

from __future__ import annotations

from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StructField, StructType, TimestampNTZType, TimestampType

from signalwatch.operators.projections import not_null, ordered, top_k, with_abs_error
from signalwatch.session import session_conf


def anomaly_strength(df: DataFrame, t: str, width: str) -> DataFrame:
    """Mean distance from normal per window, over scored rows."""
    return (
        df.where(F.col(t).isNotNull() & F.col("z_score").isNotNull())
        .groupBy(F.window(t, width).start.alias("window_start"))
        .agg(F.avg(F.abs("z_score")).alias("mean_abs_z"))
    )


def top_anomalous(df: DataFrame, k: int = 5) -> DataFrame:
    """The known regions with the largest scores."""
    strongest = (
        not_null(df, ["region", "z_score"]).groupBy("region")
        .agg(F.max(F.abs("z_score")).alias("max_abs_z"))
    )
    return top_k(strongest, "max_abs_z", k, ties=["region"])


def region_timeline(df: DataFrame, t: str = "window_start") -> DataFrame:
    """Counts per region in time order, ready for one line per region."""
    return ordered(df, ["region", t])


def error_by(
    df: DataFrame, by: list[str], truth: str = "event_count_true",
    pred: str = "event_count_pred",
) -> DataFrame:
    """Summed and mean absolute error per key."""
    return with_abs_error(df, truth, pred).groupBy(*by).agg(
        F.sum("abs_error").alias("total_abs_error"), F.avg("abs_error").alias("mean_abs_error")
    )


def diagonal_max(
    df: DataFrame, truth: str = "event_count_true", pred: str = "event_count_pred"
) -> DataFrame:
    """Add ``diagonal``, the end of the line on which a perfect forecast would lie."""
    end = df.agg(F.greatest(F.max(truth), F.max(pred)).alias("diagonal"))
    return df.withColumn("diagonal", end.select("diagonal").scalar())


def table_freshness(tables: dict[str, DataFrame], ts_col: str = "last_updated") -> DataFrame:
    """Newest time and row count of each table."""
    rows = [
        df.agg(F.max(ts_col).alias("newest"), F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "newest", "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def freshness_from_footers(spark: SparkSession, tables: dict[str, tuple[str, str]]) -> DataFrame:
    """``table_freshness`` of Parquet tables, ``{name: (path, time column)}``, without reading their rows.

    Counts and newest times are pushed down to the files' footers.  Footers hold times as numbers, so the time column is
    asked for as the number it is stored as; files that store it otherwise (as 96 bits, as Spark writes times
    by default, or in nested tables) have that one column scanned.  A row per table comes to the driver.
    """
    rows = [(name, *_newest(spark, path, t)) for name, (path, t) in tables.items()]
    found = spark.createDataFrame(rows, "table_name string, newest bigint, row_count bigint")
    return found.withColumn("newest", F.timestamp_micros("newest"))


FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def _pushed(spark: SparkSession, path: str, t: str) -> DataFrame:
    """The newest time, in microseconds, and the number of rows, for a plan with aggregate push-down."""
    fields = spark.read.parquet(path).schema.fields
    stored_as = {TimestampType: LongType(), TimestampNTZType: LongType()}
    schema = StructType([
        StructField(f.name, stored_as.get(type(f.dataType), f.dataType) if f.name == t else f.dataType) for f in fields
    ])
    return spark.read.schema(schema).parquet(path).agg(F.max(t).alias("newest"), F.count("*").alias("rows"))


def _newest(spark: SparkSession, path: str, t: str) -> tuple[int | None, int]:
    nested = any(isinstance(f.dataType, (StructType, ArrayType, MapType)) for f in spark.read.parquet(path).schema.fields)
    if not nested:
        try:
            with session_conf(spark, FOOTERS):
                newest, rows = _pushed(spark, path, t).first()
            return _micros(newest), rows
        except (PySparkException, Py4JJavaError):
            pass  # the footers don't have it
    at = F.unix_micros(F.max(F.col(t).cast("timestamp")))
    return tuple(spark.read.parquet(path).agg(at, F.count("*")).first())


def _micros(value: int | date | None) -> int | None:
    if isinstance(value, date):
        return (value - date(1970, 1, 1)).days * 86_400_000_000
    return value
