"""Scores of how unusual a count is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from signalwatch.functions import z_score
from signalwatch.operators.keyed import attach
from signalwatch.sources.sinks import append_result, read_history

Z_THRESHOLD = 2.5


def _number(df: DataFrame, value: str) -> Column:
    """The value with NaN as NULL, so that one bad reading does not spoil the statistics."""
    if isinstance(df.schema[value].dataType, (FloatType, DoubleType)):
        return F.nullif(F.col(value), F.lit(float("nan")))
    return F.col(value)


def population_stats(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """Mean and population standard deviation, overall or per key."""
    number = _number(df, value)
    return df.groupBy(*by).agg(F.avg(number).alias("mean"), F.stddev_pop(number).alias("std"))


def with_zscore(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """Add ``z_score`` against all rows, or against the rows of the same key.

    Overall statistics are one row and enter as a subquery value; per-key ones are joined.
    """
    stats = population_stats(df, value, by)
    number = _number(df, value)
    if by:
        stats = stats.withColumnsRenamed({"mean": "_mean", "std": "_std"})
        scored = attach(df, stats, list(by))
        score = z_score(number, F.col("_mean"), F.col("_std"))
        return scored.withColumn("z_score", score).drop("_mean", "_std")
    one = stats.select(F.struct("mean", "std")).scalar()
    return (
        df.withColumn("_stats", one)
        .withColumn("z_score", z_score(number, F.col("_stats.mean"), F.col("_stats.std")))
        .drop("_stats")
    )


def zscore_anomalies(
    df: DataFrame, value: str, by: list[str] = (), threshold: float = Z_THRESHOLD
) -> DataFrame:
    """Rows at least ``threshold`` deviations from the mean; none where nothing varies."""
    return with_zscore(df, value, by).where(F.abs("z_score") >= threshold)


# -- running statistics --------------------------------------------------------------------------


def moments(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """Count, mean and sum of squared deviations (``n``, ``mean``, ``m2``) per key: what a later merge needs."""
    number = _number(df, value)
    return df.groupBy(*by).agg(
        F.count(number).alias("n"), F.avg(number).alias("mean"), (F.var_pop(number) * F.count(number)).alias("m2")
    )


def merge_moments(parts: DataFrame, by: list[str] = ()) -> DataFrame:
    """Moments of all parts of a key together.

    The deviations of the parts' means from the common mean are added to those within the parts (Chan et
    al.), so large means lose no digits.  A key has a row per part, such as a day, not per value.
    """
    by = list(by)
    means = parts.groupBy(*by).agg(
        F.sum("n").alias("_n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("_mean")
    )
    apart = F.col("mean") - F.col("_mean")
    if by:
        both = attach(parts, means, by)
    else:
        both = parts.withColumn("_all", means.select(F.struct("_n", "_mean")).scalar()).select("*", "_all.*")
    return both.groupBy(*by).agg(
        F.first("_n").alias("n"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"),
    )


def score_with_moments(df: DataFrame, value: str, known: DataFrame, by: list[str]) -> DataFrame:
    """Add ``z_score`` against merged moments of the row's key; NULL for unknown keys and where nothing varies."""
    stats = known.select(
        *by, F.col("mean").alias("_mean"), F.sqrt(F.try_divide("m2", "n")).alias("_std")
    )
    scored = attach(df, stats, list(by))
    score = z_score(_number(df, value), F.col("_mean"), F.col("_std"))
    return scored.withColumn("z_score", score).drop("_mean", "_std")


def update_moments(rows: DataFrame, path: str, part: str, value: str, by: list[str]) -> DataFrame:
    """Add the moments of one part, such as a day, to the history under ``path``, and merge all of it.

    Only the part's rows are read; a part that is added again replaces itself.
    """
    append_result(moments(rows, value, by), path, part)
    return merge_moments(read_history(rows.sparkSession, path), by)
