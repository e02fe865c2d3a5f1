"""Row-wise columns and filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.functions import cyclical


def with_time_parts(df: DataFrame, t: str = "event_timestamp") -> DataFrame:
    """Add ``day_of_week`` (1 is Sunday) and ``hour_of_day``."""
    return df.withColumns({"day_of_week": F.dayofweek(t), "hour_of_day": F.hour(t)})


def stamp(df: DataFrame, **cols: object) -> DataFrame:
    """Add constant columns such as ``last_updated``, ``detected_at`` or ``run_id``.

    Pass ``None`` to stamp the time of the run.
    """
    return df.withColumns(
        {
            name: value if isinstance(value, Column)
            else F.current_timestamp() if value is None else F.lit(value)
            for name, value in cols.items()
        }
    )


def with_cyclical(
    df: DataFrame, col: str = "hour_of_day", period: float = 24, prefix: str = "hour"
) -> DataFrame:
    sin, cos = cyclical(col, period)
    return df.withColumns({f"{prefix}_sin": sin, f"{prefix}_cos": cos})


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cast to double; text that is no number becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast("double") for name in cols})


def drop_null_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    for name in cols:
        df = df.where(F.col(name).isNotNull())
    return df


def with_abs_error(
    df: DataFrame, truth: str = "event_count_true", pred: str = "event_count_pred"
) -> DataFrame:
    return df.withColumn("abs_error", F.abs(F.col(truth) - F.col(pred)))


def lookback(
    df: DataFrame, t: str, minutes: int, as_of: datetime | Column | None = None
) -> DataFrame:
    """Rows of the last ``minutes`` before ``as_of``, which defaults to the newest event time.

    The default is a one-value subquery, so the bound still reaches the scan as a filter.  The start is
    worked out inside the subquery: a scan takes a bare value only, not a sum.
    """
    span = F.expr(f"interval {int(minutes)} minutes")
    if as_of is None:
        start = df.agg((F.max(t) - span).alias("start")).select("start").scalar()
        return df.where(F.col(t) >= start)
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.where((F.col(t) >= end - span) & (F.col(t) <= end))


def at_least(df: DataFrame, col: str, threshold: float) -> DataFrame:
    return df.where(F.col(col) >= threshold)


def top_k(
    df: DataFrame, value: str, k: int | None = None, ties: list[str] = ()
) -> DataFrame:
    """Rows by descending value, ``ties`` ascending; the first ``k`` of them if given."""
    ranked = df.orderBy(F.col(value).desc(), *[F.col(c).asc() for c in ties])
    return ranked if k is None else ranked.limit(k)


def ordered(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.orderBy(*cols)
