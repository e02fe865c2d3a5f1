"""Event-time windows and series of buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.functions import bucket_number, bucket_start, seconds, z_score
from signalwatch.operators.keyed import number_places, trailing


def tumbling_counts(
    df: DataFrame, t: str, width: str, by: list[str] = (), value: str | None = None
) -> DataFrame:
    """Events per window of ``width`` and key; rows without an event time belong to no window.

    Works on streams: the window column keeps the watermark.
    """
    total = F.count("*") if value is None else F.sum(value)
    return (
        df.groupBy(F.window(t, width), *by)
        .agg(total.alias("event_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *by,
            "event_count",
        )
    )


def bucket_counts(
    df: DataFrame, t: str, width: str, by: list[str] = (), fill: bool = True,
    value: str | None = None,
) -> DataFrame:
    """Events (or a sum) per bucket and key, with zeros between a key's first and last bucket.

    The zero rows come from each key's bounds: first one row per 4096 buckets, then the buckets, so
    that many tasks generate a long series.  Real and zero rows meet in one aggregation.  Asking
    for a count next to the bounds keeps both uses of the counts on one shuffle; bounds alone would
    prune the counts away and read the events a second time.
    """
    step = 4096
    total = F.count("*") if value is None else F.sum(value)
    counts = (
        df.where(F.col(t).isNotNull())
        .groupBy(*by, bucket_number(t, width).alias("_n"))
        .agg(total.alias("event_count"))
    )
    if fill:
        first, last = F.col("_first"), F.col("_last")
        stretches = (
            counts.groupBy(*by)
            .agg(
                F.min("_n").alias("_first"), F.max("_n").alias("_last"),
                F.max("event_count").alias("_most"),
            )
            .where(F.col("_most").isNotNull())
            .select(*by, "_last", F.explode(F.sequence(first, last, F.lit(step))).alias("_from"))
            .repartition(*by, "_from")
        )
        zeros = stretches.select(
            *by,
            F.explode(
                F.sequence("_from", F.least(last, F.col("_from") + (step - 1)))
            ).alias("_n"),
            F.lit(0).cast(counts.schema["event_count"].dataType).alias("event_count"),
        )
        counts = (
            counts.unionByName(zeros).groupBy(*by, "_n")
            .agg(F.sum("event_count").alias("event_count"))
        )
    return counts.select(*by, bucket_start("_n", width).alias("bucket"), "event_count")


def session_counts(
    df: DataFrame, t: str, gap: str, by: list[str] = (), value: str | None = None, block: str = "1 day"
) -> DataFrame:
    """Events (or a sum) per session: a run of a key's events in which each comes at most ``gap`` after
    the one before.  A session ends a gap after its last event.

    A session window alone sends all events of a key to one task.  Here sessions are found per key and block of
    time; only those within a gap of a block's edges, two at most per block, can go on in the next one, and
    runs of these are put together.  Rows without an event time belong to no session.
    """
    by, width = list(by), max(seconds(block), 2 * seconds(gap))
    total = F.count("*") if value is None else F.sum(value)
    length = F.expr(f"interval {seconds(gap)} seconds")
    # bounds are aggregates: a filter on the window itself would be pushed down to the single events
    parts = (
        df.where(F.col(t).isNotNull())
        .groupBy(*by, bucket_number(t, f"{width} seconds").alias("_n"), F.session_window(t, gap))
        .agg(
            F.min(t).alias("session_start"), (F.max(t) + length).alias("session_end"), total.alias("event_count")
        )
        .select(*by, "session_start", "session_end", "event_count", bucket_start("_n", f"{width} seconds").alias("_from"))
    )
    at_edge = (F.col("session_start") <= F.col("_from") + length) | (
        F.col("session_end") >= F.col("_from") + F.expr(f"interval {width} seconds")
    )
    # a session inside its block is whole; those at edges, one or two per key and block, are walked per key
    placed = parts.withColumn("_edge", at_edge).withColumn("_inside", F.when(~at_edge, F.col("_from")))
    walk = Window.partitionBy(*by, "_edge", "_inside").orderBy("session_start")
    starts = F.coalesce(~F.col("_edge") | (F.col("session_start") > F.lag("session_end").over(walk)), F.lit(True))
    run = F.sum("_new").over(walk.rowsBetween(Window.unboundedPreceding, 0))
    return (
        placed.withColumn("_new", starts.cast("int")).withColumn("_run", run)
        .groupBy(*by, "_edge", "_inside", "_run")
        .agg(
            F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
            F.sum("event_count").alias("event_count"),
        )
        .drop("_edge", "_inside", "_run")
    )


def sliding_counts(
    df: DataFrame, t: str, width: str, slide: str, by: list[str] = (), value: str | None = None,
    every_slide: bool = False,
) -> DataFrame:
    """Events in the last ``width``, evaluated at the end of each ``slide`` that has events.

    Counts are taken once per slide and then summed over a trailing frame, instead of copying each
    event into every window that covers it.  Windows are closed at the start and open at the end.
    ``every_slide`` also evaluates quiet slides, as long as their window still covers an event.
    """
    steps = seconds(width) // seconds(slide)
    if steps * seconds(slide) != seconds(width):
        raise ValueError("the width must be a multiple of the slide")
    total = F.count("*") if value is None else F.sum(value)
    per_slide = (
        df.where(F.col(t).isNotNull())
        .groupBy(*by, bucket_number(t, slide).alias("_n"))
        .agg(total.alias("_events"))
    )
    if every_slide:
        per_slide = _with_quiet_slides(per_slide, steps, list(by))
    summed = trailing(
        per_slide, "_n", steps - 1, list(by),
        {"event_count": lambda w: F.sum("_events").over(w.rangeBetween(-(steps - 1), 0))},
    )
    return summed.select(
        *by,
        bucket_start(F.col("_n") - (steps - 1), slide).alias("window_start"),
        bucket_start(F.col("_n") + 1, slide).alias("window_end"),
        "event_count",
    )


def _with_quiet_slides(per_slide: DataFrame, steps: int, by: list[str]) -> DataFrame:
    """Add empty slides after each slide, up to the next one or until its events are out of reach.

    The next slide is found by a trailing frame over the mirrored time axis.
    """
    nearby = trailing(
        per_slide.withColumn("_back", -F.col("_n")), "_back", steps - 1, by,
        {"_next": lambda w: F.min("_n").over(w.rangeBetween(-(steps - 1), -1))},
    )
    last = F.coalesce(F.col("_next"), F.col("_n") + steps) - 1
    return nearby.withColumn("_at", F.explode(F.sequence("_n", last))).select(
        *by,
        F.col("_at").alias("_n"),
        F.when(F.col("_at") == F.col("_n"), F.col("_events")).otherwise(0).alias("_events"),
    )


def _positioned(
    df: DataFrame, order: list[str], by: list[str], width: str | None
) -> DataFrame:
    """Add ``_pos``, the place of each row in its key's series.

    With ``width`` the first order column is a bucket time and its bucket number is the place, so
    frames count buckets, present or not; this needs no shuffle.  Without, the places that occur are
    numbered in order.  Rows may share a place; a frame over a range of places holds all their rows.
    """
    if width is None:
        return number_places(df, order, by)
    return df.withColumn("_pos", bucket_number(order[0], width))


def trailing_mean(
    df: DataFrame, order: list[str], value: str, rows: int, by: list[str] = (),
    width: str | None = None, name: str = "trailing_mean",
) -> DataFrame:
    """Mean of the last ``rows`` places including the current one, fewer at the start."""
    return trailing(
        _positioned(df, order, by, width), "_pos", rows - 1, list(by),
        {name: lambda w: F.avg(value).over(w.rangeBetween(-(rows - 1), 0))},
    ).drop("_pos")


def lagged_mean(
    df: DataFrame, order: list[str], value: str, k: int, by: list[str] = (),
    width: str | None = None, name: str = "lagged_mean",
) -> DataFrame:
    """Mean over the rows of the ``k`` places before the current one; rows that have fewer places with
    rows before them are dropped."""
    return (
        trailing(
            _positioned(df, order, by, width), "_pos", k, list(by),
            {
                name: lambda w: F.avg(value).over(w.rangeBetween(-k, -1)),
                "_seen": lambda w: F.collect_set("_pos").over(w.rangeBetween(-k, -1)),
            },
        )
        .where(F.size("_seen") == k)
        .drop("_pos", "_seen")
    )


def with_lags(
    df: DataFrame, order: list[str], value: str, lags: list[int], by: list[str] = (),
    width: str | None = None,
) -> DataFrame:
    """Add ``<value>_lag_<i>``: the value ``i`` places earlier, NULL where there is none."""
    return trailing(
        _positioned(df, order, by, width), "_pos", max(lags), list(by),
        {
            f"{value}_lag_{i}": lambda w, i=i: F.max(value).over(w.rangeBetween(-i, -i))
            for i in lags
        },
    ).drop("_pos")


def sustained(
    df: DataFrame, order: list[str], value: str, threshold: float, k: int, by: list[str] = (),
    width: str | None = None,
) -> DataFrame:
    """Rows that end a run of ``k`` places in a row, all of whose rows are at or above the threshold."""
    reached = F.coalesce(F.col(value) >= threshold, F.lit(False))
    frame = -(k - 1), 0
    return (
        trailing(
            _positioned(df, order, by, width).withColumn("_hit", reached), "_pos", k - 1, list(by),
            {
                "_run": lambda w: F.collect_set("_pos").over(w.rangeBetween(*frame)),
                "_all": lambda w: F.bool_and("_hit").over(w.rangeBetween(*frame)),
            },
        )
        .where(F.col("_all") & (F.size("_run") == k))
        .drop("_pos", "_hit", "_run", "_all")
    )


def baseline_ratio(
    df: DataFrame, t: str, value: str, width: str, short: int, long: int, by: list[str] = ()
) -> DataFrame:
    """Mean of the last ``short`` buckets against the mean of the last ``long`` of a filled series."""
    return trailing(
        df.withColumn("_pos", bucket_number(t, width)), "_pos", long - 1, list(by),
        {
            "short_mean": lambda w: F.avg(value).over(w.rangeBetween(-(short - 1), 0)),
            "long_mean": lambda w: F.avg(value).over(w.rangeBetween(-(long - 1), 0)),
        },
    ).withColumn("ratio", F.try_divide("short_mean", "long_mean")).drop("_pos")


def rolling_sum(
    df: DataFrame, t: str, value: str, hours: int, by: list[str] = (), width: str = "1 hour",
    name: str = "rolling_sum",
) -> DataFrame:
    """Sum over the last ``hours`` of a bucket series; buckets may be missing."""
    steps = hours * 3600 // seconds(width)
    return trailing(
        df.withColumn("_pos", bucket_number(t, width)), "_pos", steps - 1, list(by),
        {name: lambda w: F.sum(value).over(w.rangeBetween(-(steps - 1), 0))},
    ).drop("_pos")


def anomaly_overlay(
    series: DataFrame, anomalies: DataFrame, t: str, value: str, factor: float = 1.05
) -> DataFrame:
    """A series with its anomaly marks, drawn a little above the highest value.

    ``anomalies`` has one row per marked instant of ``t``; ``mark`` is NULL where there is none.
    """
    top = series.agg((F.max(value) * F.lit(factor)).alias("level"))
    marked = anomalies.select(F.col(t).alias("_marked_at")).distinct()
    return (
        series.join(marked, F.col(t) == F.col("_marked_at"), "left")
        .withColumn(
            "mark", F.when(F.col("_marked_at").isNotNull(), top.select("level").scalar())
        )
        .drop("_marked_at")
    )


def history_zscore(
    df: DataFrame, t: str, value: str, width: str, buckets: int, by: list[str] = ()
) -> DataFrame:
    """Score each bucket against the ``buckets`` before it of the same key."""
    return trailing(
        df.withColumn("_pos", bucket_number(t, width)), "_pos", buckets, list(by),
        {
            "history_mean": lambda w: F.avg(value).over(w.rangeBetween(-buckets, -1)),
            "history_std": lambda w: F.stddev_pop(value).over(w.rangeBetween(-buckets, -1)),
        },
    ).withColumn(
        "z_score", z_score(F.col(value), F.col("history_mean"), F.col("history_std"))
    ).drop("_pos")
