"""Running aggregates over events, on tables and on streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.operators.ingest import with_severity_score
from signalwatch.operators.keyed import attach
from signalwatch.operators.projections import lookback, not_null, top_k, with_time_parts


def symptom_by_region(df: DataFrame) -> DataFrame:
    """Events and mean severity score per region and symptoms text."""
    return (
        with_severity_score(df)
        .groupBy("region", "symptoms")
        .agg(
            F.count("*").alias("event_count"),
            F.avg("severity_score").alias("avg_severity_score"),
        )
    )


def severity_by_hour(df: DataFrame, t: str = "event_timestamp") -> DataFrame:
    """Events per severity and hour of day; see ``share_of_total`` for the percentage."""
    return (
        df.withColumn("hour_of_day", F.hour(t))
        .groupBy("severity", "hour_of_day")
        .agg(F.count("*").alias("event_count"))
    )


def temporal_patterns(
    df: DataFrame, t: str = "event_timestamp", exact: bool = True
) -> DataFrame:
    """Events and distinct patients per day of week and hour of day.

    ``exact=False`` uses a mergeable sketch, the only form a stream supports.  ``patient_rows`` counts
    the rows that name a patient.
    """
    distinct = F.count_distinct("patient_id") if exact else F.approx_count_distinct("patient_id")
    return (
        with_time_parts(df, t)
        .groupBy("day_of_week", "hour_of_day")
        .agg(
            F.count("*").alias("event_count"),
            distinct.alias("unique_patients"),
            F.count("patient_id").alias("patient_rows"),
        )
    )


def env_avg_temp(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(F.avg("temperature_f").alias("avg_temperature_f"))


def env_air_quality(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(
        F.avg("air_quality_index").alias("avg_air_quality"),
        F.avg("pollen_count").alias("avg_pollen_count"),
        F.avg("uv_index").alias("avg_uv_index"),
    )


def env_hourly(df: DataFrame, t: str = "event_timestamp") -> DataFrame:
    return (
        df.withColumn("hour_of_day", F.hour(t))
        .groupBy("hour_of_day")
        .agg(
            F.avg("temperature_f").alias("average_temp"),
            F.avg("humidity_percent").alias("average_humidity"),
            F.avg("wind_speed_mph").alias("average_windspeed"),
        )
    )


def events_by_region(
    df: DataFrame, t: str, minutes: int, as_of: datetime | Column | None = None
) -> DataFrame:
    """Events per known region in the lookback window, most first."""
    recent = not_null(lookback(df, t, minutes, as_of), ["region"])
    counts = recent.groupBy("region").agg(F.count("*").alias("event_count"))
    return top_k(counts, "event_count", ties=["region"])


def share_of_total(df: DataFrame, value: str, within: list[str] = ()) -> DataFrame:
    """Add ``percentage``: a value's share of the total, overall or within each group.

    An empty table stays empty; a total of zero gives NULL.
    """
    totals = df.groupBy(*within).agg(F.sum(value).alias("_total"))
    if within:
        with_total = attach(df, totals, list(within))
    else:
        with_total = df.withColumn("_total", totals.select("_total").scalar())
    return with_total.withColumn(
        "percentage", F.try_divide(100.0 * F.col(value), F.col("_total"))
    ).drop("_total")


def severity_share(
    df: DataFrame, t: str | None = None, minutes: int | None = None,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Events per severity and their share of all events, optionally in a lookback window."""
    recent = df if minutes is None else lookback(df, t, minutes, as_of)
    totals = recent.groupBy("severity").agg(F.count("*").alias("total_events"))
    return share_of_total(totals, "total_events")


def category_share(
    df: DataFrame, col: str, category: str, by: list[str] = (), value: str | None = None
) -> DataFrame:
    """Share of rows (or of a summed value) in one category, 0.0 where there is none."""
    weight = F.lit(1) if value is None else F.col(value)
    hits = F.sum(F.when(F.col(col) == category, weight).otherwise(0))
    share = F.coalesce(F.try_divide(100.0 * hits, F.sum(weight)), F.lit(0.0))
    return df.groupBy(*by).agg(share.alias("percentage"))


def pivot_counts(
    df: DataFrame, row: str, col: str, values: list, value: str, prefix: str = ""
) -> DataFrame:
    """Sums of ``value`` with one column per listed value of ``col``, 0 where there is none."""
    return df.where(F.col(row).isNotNull()).groupBy(row).agg(
        *[
            F.sum(F.when(F.col(col) == v, F.col(value)).otherwise(0)).alias(f"{prefix}{v}")
            for v in values
        ]
    )


def avg_by(df: DataFrame, by: list[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(f"avg_{value}"))


def region_totals(df: DataFrame, k: int | None = 10) -> DataFrame:
    """Known regions by total event count, the first ``k`` of them."""
    totals = not_null(df, ["region"]).groupBy("region").agg(
        F.sum("event_count").alias("event_count")
    )
    return top_k(totals, "event_count", k, ties=["region"])
