"""Scalar expressions.  Each returns a Column built from Spark's own functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalwatch.schemas import EVENT_TIME_FORMAT, SEVERITY_SCORES

__all__ = [
    "bucket_number", "bucket_start", "cyclical", "event_time", "severity_score", "seconds",
    "z_score",
]

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds(width: str) -> int:
    """Length in seconds of a fixed interval such as ``"5 minutes"``."""
    parts = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day|week)s?\s*", width)
    if not parts or int(parts[1]) == 0:
        raise ValueError(f"not a fixed interval: {width!r}")
    return int(parts[1]) * _UNITS[parts[2]]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(text: Column | str, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Parse an event time; text that does not match becomes NULL instead of failing the job."""
    return F.try_to_timestamp(_col(text), F.lit(fmt))


def severity_score(severity: Column | str) -> Column:
    """Score of a severity word, exact and case-sensitive; anything else (also NULL) is 0."""
    word = _col(severity)
    score = F
    for name, points in SEVERITY_SCORES.items():
        score = score.when(word == name, F.lit(points))
    return score.otherwise(F.lit(0))


def cyclical(value: Column | str, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value's position on a cycle of the given period."""
    angle = 2 * F.pi() * _col(value) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def z_score(value: Column, mean: Column, std: Column) -> Column:
    """Standard score; NULL where the deviation is NULL or zero."""
    return (value - mean) / F.nullif(std, F.lit(0.0))


def bucket_number(t: Column | str, width: str) -> Column:
    """Number of whole intervals between the epoch and ``t``: a gapless integer time axis."""
    return F.floor(F.unix_seconds(_col(t).cast("timestamp")) / seconds(width)).cast("bigint")


def bucket_start(number: Column | str, width: str) -> Column:
    """Inverse of ``bucket_number``: the instant at which an interval starts."""
    return F.timestamp_seconds(_col(number) * seconds(width))
