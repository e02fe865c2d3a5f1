"""Which alerts fire, at which level, how often, and what they say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.functions import z_score
from signalwatch.operators.analytics import category_share, share_of_total
from signalwatch.operators.keyed import attach
from signalwatch.operators.matching import asof_join
from signalwatch.operators.projections import at_least, not_null
from signalwatch.operators.timeseries import history_zscore
from signalwatch.sources.sinks import feature_table

# Thresholds used unless the caller passes others.
VOLUME_THRESHOLD = 500
SEVERE_SHARE_THRESHOLD = 40.0
ADVANCED_CONFIG = {
    "poll_interval_seconds": 60,
    "lookback_minutes": 5,
    "volume_threshold": 100,
    "z_medium": 0.5,
    "z_high": 1.5,
    "cooldown_minutes": 10,
    "top_n_regions": 5,
}

LEVELS = ("LOW", "MEDIUM", "HIGH")

# The wording of alert messages, line by line.
TIME_LINE = "Time: %s"
TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
ADVANCED_TITLE = "Symptom alert: more reports than usual"
LOOKBACK_LINE = "Evaluated: %d minutes, from %d reports on"
LEVEL_LINE = "Level: %s"
REGIONS_TITLE = "Regions above the threshold:"
REGION_LINE = "- %s: %d events (z=%s)"
MIX_TITLE = "Shares by severity:"
MIX_LINE = "- %s: %s%%"
NO_MIX_LINE = "Shares by severity: none known."
VOLUME_TITLE = "Volume alert: many reports"
VOLUME_THRESHOLD_LINE = "Threshold: %d reports in %d minutes"
VOLUME_REGIONS_TITLE = "Regions:"
VOLUME_REGION_LINE = "- %s: %d reports in %d minutes"
SHARE_TITLE = "Severity alert: many severe reports"
SHARE_LINE = "Severe: %s%% of reports (threshold %s%%)"

_DAY_MICROS = 86_400_000_000


# -- rules ---------------------------------------------------------------------------------------


def volume_alerts(
    windows: DataFrame, threshold: float = VOLUME_THRESHOLD, value: str = "event_count"
) -> DataFrame:
    """Windows of known regions with at least ``threshold`` events."""
    return at_least(not_null(windows, ["region"]), value, threshold)


def share_alerts(
    df: DataFrame, t: str, width: str, category: str = "severe",
    threshold: float = SEVERE_SHARE_THRESHOLD, col: str = "severity", value: str | None = None,
) -> DataFrame:
    """Windows in which at least ``threshold`` percent of the events are of one category.

    ``df`` has one row per event, or counts of events in ``value``.
    """
    window = F.window(t, width)
    shares = category_share(
        df.where(F.col(t).isNotNull())
        .withColumns({"window_start": window.start, "window_end": window.end}),
        col, category, ["window_start", "window_end"], value,
    )
    return at_least(shares, "percentage", threshold)


def level_of(max_z: Column, config: dict) -> Column:
    """HIGH or MEDIUM by the largest score, else LOW; no score (nothing varies) is LOW."""
    return (
        F.when(max_z >= config["z_high"], "HIGH")
        .when(max_z >= config["z_medium"], "MEDIUM")
        .otherwise("LOW")
    )


def _hot(
    windows: DataFrame, config: dict, value: str, history: tuple[str, int] | None
) -> DataFrame:
    """Hot regions of each window; scored against their own past if ``history`` is given."""
    if history is not None:
        slide, steps = history
        windows = history_zscore(windows, "window_end", value, slide, steps, ["region"]).drop(
            "history_mean", "history_std"
        )
    return volume_alerts(windows, config["volume_threshold"], value)


def _hot_stats(hot: DataFrame, value: str) -> DataFrame:
    """Per window: how many regions are hot, their statistics and the largest score.

    Among the hot regions of a window the largest score is that of the largest count, so one
    aggregation gives it; scores against the past are there already.
    """
    mean, std = F.avg(value), F.stddev_pop(value)
    largest = (
        F.max("z_score") if "z_score" in hot.columns else z_score(F.max(value), mean, std)
    )
    return hot.groupBy("window_start", "window_end").agg(
        F.count("*").alias("hot_regions"), mean.alias("_mean"), std.alias("_std"),
        largest.alias("max_z"),
    )


def alert_level(
    windows: DataFrame, config: dict | None = None, value: str = "event_count",
    history: tuple[str, int] | None = None,
) -> DataFrame:
    """Level of each window: how far its most unusual hot region stands out.

    Hot regions are the known regions at or above the volume threshold; a window without any has no
    level.  A region is compared with the other hot regions of the window, or, given ``history`` as
    ``(slide, steps)``, with its own last ``steps`` evaluations.
    """
    config = {**ADVANCED_CONFIG, **(config or {})}
    return (
        _hot_stats(_hot(windows, config, value, history), value)
        .withColumn("level", level_of(F.col("max_z"), config))
        .drop("_mean", "_std")
    )


def top_regions(
    windows: DataFrame, n: int = ADVANCED_CONFIG["top_n_regions"], value: str = "event_count"
) -> DataFrame:
    """The ``n`` busiest regions of each window with their ``rank``."""
    busiest = Window.partitionBy("window_end").orderBy(F.col(value).desc(), F.col("region"))
    return windows.withColumn("rank", F.row_number().over(busiest)).where(F.col("rank") <= n)


def severity_mix(counts: DataFrame, value: str = "event_count") -> DataFrame:
    """Severity shares of each window as one list, largest first."""
    shares = share_of_total(counts, value, ["window_end"])
    return shares.groupBy("window_end").agg(
        F.transform(
            F.array_sort(
                F.collect_list(
                    F.struct((-F.col(value)).alias("o"), "severity", "percentage")
                )
            ),
            lambda x: F.struct(x.severity.alias("severity"), x.percentage.alias("percentage")),
        ).alias("mix")
    )


def advanced_alerts(
    windows: DataFrame, severities: DataFrame, config: dict | None = None,
    min_level: str = "LOW", value: str = "event_count",
    history: tuple[str, int] | None = None, cooldown_keys: list[str] | None = None,
) -> DataFrame:
    """One alert per window with hot regions: level, busiest hot regions and severity mix.

    ``windows`` counts events per window and region, ``severities`` per window and severity.  Scores
    and levels are those of ``alert_level``.  With ``cooldown_keys`` (``[]``, or ``["level"]`` for a
    clock per level) the cooldown is applied to the levels, before the lists are put together.
    """
    config = {**ADVANCED_CONFIG, **(config or {})}
    hot = _hot(windows, config, value, history)
    fired = (
        _hot_stats(hot, value).withColumn("level", level_of(F.col("max_z"), config))
        .where(F.col("level").isin(*LEVELS[LEVELS.index(min_level):]))
    )
    if cooldown_keys is not None:
        fired = apply_cooldown(fired, "window_end", cooldown_keys, config["cooldown_minutes"])
    # the lists are made for the windows that fired only
    ends = fired.select("window_end").distinct()
    hot, severities = (
        frame.join(ends, "window_end", "left_semi") for frame in (hot, severities)
    )
    top = (
        top_regions(hot, config["top_n_regions"], value).withColumnRenamed(value, "events")
        .join(fired, ["window_start", "window_end"])
    )
    if history is None:
        peers = z_score(F.col("events"), F.col("_mean"), F.col("_std"))
        top = top.withColumn("z_score", peers)
    listed = (
        top.groupBy("window_start", "window_end", "level", "hot_regions")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "region", "events", "z_score"))),
                lambda x: F.struct(
                    x.region.alias("region"), x.events.alias("events"),
                    x.z_score.alias("z_score"),
                ),
            ).alias("regions")
        )
    )
    return listed.join(severity_mix(severities, value), "window_end", "left").select(
        "window_start", "window_end", "level", "hot_regions", "regions", "mix"
    )


def multi_metric_alerts(
    frames: list[DataFrame], on: list[str], minimum: dict[str, float]
) -> DataFrame:
    """Rows where every listed metric reaches its minimum at once.

    Each frame has one row per key, so the joins stay one to one.
    """
    joined = frames[0]
    for frame in frames[1:]:
        joined = joined.join(frame, on)
    for metric, least in minimum.items():
        joined = at_least(joined, metric, least)
    return joined


def multi_metric_in_time(
    base: DataFrame, others: list[tuple[DataFrame, str]], t: str, by: list[str], minimum: dict[str, float],
    within: str | None = None,
) -> DataFrame:
    """Rows of ``base`` whose metrics, and the newest ones of every other table at or before their time, all
    reach their minimum.

    ``others`` are (table, time column) pairs that need not be evaluated at the same times; ``within`` bounds the age of
    what is taken.  A row without a partner does not reach the minimum.
    """
    joined = base
    for frame, time in others:
        joined = asof_join(joined, frame, t, time, list(by), within=within)
    for metric, least in minimum.items():
        joined = at_least(joined, metric, least)
    return joined


# -- cooldown ------------------------------------------------------------------------------------


def apply_cooldown(df: DataFrame, t: str, keys: list[str], minutes: float) -> DataFrame:
    """Alerts that fire when a key stays silent for ``minutes`` after each alert that fired.

    A suppressed alert does not restart the clock, so whether an alert fires depends on the whole chain
    before it.  The chain is a path through the key's distinct instants: behind a fired one the next to fire is
    the first at least a cooldown later.  These pointers come from one sort per key and block of time.
    Each round then stores, for the instants that are still that far from the end, the next three steps and
    the fourth, and takes the fourth as the step of the round after; the rounds are the base-4 logarithm of the longest
    chain.  The fired instants are read off these tables from the longest steps down, starting at each
    key's first one.  Every table has one row per instant and is joined by key and instant, so neither a hot
    key nor ``keys=[]``, one clock for all alerts, gathers in one task.

    Of alerts of a key at the same instant the fired one is not distinguished: all rows of that instant
    are returned.  Alerts without a time do not fire.  NULL is a key like any other.
    """
    pause = int(minutes * 60_000_000)
    if pause <= 0:
        return df
    keys = list(keys)
    at = F.unix_micros(F.col(t).cast("timestamp"))
    instants = feature_table(
        df.where(F.col(t).isNotNull()).select(*keys, at.alias("_at")).distinct(), "cooldown_instants"
    )
    steps, levels = feature_table(_next_to_fire(instants, keys, pause), "cooldown_steps"), []
    while not steps.isEmpty():
        reach = steps.withColumnRenamed("_next", "_1")
        for n in (1, 2, 3):
            reach = _hop(reach, steps, keys, f"_{n}", f"_{n + 1}")
        levels.append(feature_table(reach, "cooldown_reach"))
        steps = levels[-1].where("_4 is not null").select(*keys, "_at", F.col("_4").alias("_next"))
    fired = instants.groupBy(*keys).agg(F.min("_at").alias("_at"))
    for level in reversed(levels):
        ahead = attach(fired, level.drop("_4"), [*keys, "_at"])
        fired = ahead.select(*keys, F.explode(F.array_compact(F.array("_at", "_1", "_2", "_3"))).alias("_at"))
    names = {k: f"_f_{k}" for k in keys}
    same = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys]
    return df.join(fired.withColumnsRenamed(names), [at == F.col("_at"), *same], "left_semi")


def _next_to_fire(instants: DataFrame, keys: list[str], pause: int) -> DataFrame:
    """(keys, _at, _next) of the instants that have a later one at least ``pause`` behind them.

    Instants and the times at which they let others fire are sorted together in blocks of time; a time with no
    instant behind it in its block takes the first one of the key's later blocks.
    """
    width = max(_DAY_MICROS, 32 * pause)
    times = instants.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("_at").alias("_x"), F.col("_at").alias("_hit"), F.lit(None).cast("long").alias("_of")),
                F.struct((F.col("_at") + pause).alias("_x"), F.lit(None).cast("long").alias("_hit"), F.col("_at").alias("_of")),
            )
        ).alias("_e"),
    ).select(*keys, "_e.*", F.floor(F.col("_e._x") / width).alias("_block"))
    # frames that begin at the end of the order are sums of a running kind
    behind = Window.partitionBy(*keys, "_block").orderBy(F.desc("_x")).rangeBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy(*keys).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    # one row per key and block
    blocks = (
        times.groupBy(*keys, "_block").agg(F.min("_hit").alias("_first"))
        .withColumn("_later", F.min("_first").over(later)).drop("_first")
    )
    found = times.withColumn("_found", F.min("_hit").over(behind)).where("_of is not null")
    return (
        attach(found, blocks, [*keys, "_block"])
        .select(*keys, F.col("_of").alias("_at"), F.coalesce("_found", "_later").alias("_next"))
        .where("_next is not null")
    )


def _hop(df: DataFrame, steps: DataFrame, keys: list[str], start: str, out: str) -> DataFrame:
    """Add the step behind ``start``, NULL where there is none."""
    names = {k: f"_s_{k}" for k in keys}
    ahead = steps.withColumnsRenamed({**names, "_at": "_s_at", "_next": out})
    # rows that have ended already are spread by their own time instead of by NULL
    spread = F.coalesce(F.col(start), F.col("_at"))
    same = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys]
    return df.join(
        ahead, [spread == F.col("_s_at"), F.col(start).isNotNull(), *same], "left"
    ).drop("_s_at", *names.values())


# -- text ----------------------------------------------------------------------------------------


def _fixed(value: Column, places: int) -> Column:
    """Decimal text with ties to even, as in ``12.25 -> 12.2``; NULL stays NULL."""
    text = F.format_string(f"%.{places}f", F.bround(value, places))
    return F.when(value.isNotNull(), text)


def _time_line(t: str) -> Column:
    return F.format_string(TIME_LINE, F.date_format(t, TIME_PATTERN))


def _each(items: Column, line) -> Column:
    return F.array_join(F.transform(items, line), "\n")


def _message(*lines: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


def format_alert(df: DataFrame, config: dict | None = None, t: str = "window_end") -> DataFrame:
    """Add the ``message`` of each advanced alert."""
    config = {**ADVANCED_CONFIG, **(config or {})}

    def region_line(r: Column) -> Column:
        score = F.coalesce(_fixed(r.z_score, 2), F.lit("nan"))
        return F.format_string(REGION_LINE, r.region, r.events, score)

    def mix_line(m: Column) -> Column:
        name = F.coalesce(m.severity, F.lit("None"))
        return F.format_string(MIX_LINE, name, _fixed(m.percentage, 1))

    mix = F.when(F.size("mix") > 0, _message(MIX_TITLE, _each(F.col("mix"), mix_line)))
    return df.withColumn(
        "message",
        _message(
            ADVANCED_TITLE,
            _time_line(t),
            LOOKBACK_LINE % (config["lookback_minutes"], config["volume_threshold"]),
            F.format_string(LEVEL_LINE, "level"),
            "",
            REGIONS_TITLE,
            _each(F.col("regions"), region_line),
            "",
            mix.otherwise(F.lit(NO_MIX_LINE)),
        ),
    )


def format_volume_alert(
    hot: DataFrame, threshold: int = VOLUME_THRESHOLD, minutes: int = 5,
    value: str = "event_count",
) -> DataFrame:
    """One ``message`` per window that lists its hot regions, busiest first."""
    regions = F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("o"), "region")))
    lines = _each(
        regions,
        lambda r: F.format_string(VOLUME_REGION_LINE, r.region, -r.o, F.lit(minutes)),
    )
    return hot.groupBy("window_end").agg(
        _message(
            VOLUME_TITLE,
            _time_line("window_end"),
            VOLUME_THRESHOLD_LINE % (threshold, minutes),
            VOLUME_REGIONS_TITLE,
            lines,
        ).alias("message")
    )


def volume_alert_lines(
    hot: DataFrame, threshold: int = VOLUME_THRESHOLD, minutes: int = 5, value: str = "event_count",
) -> DataFrame:
    """``format_volume_alert`` line by line: (window_end, line, text), however many regions a window has.

    Lines 1 to 4 are the head, then the regions, busiest first.
    """
    head = [
        F.lit(VOLUME_TITLE), _time_line("window_end"), F.lit(VOLUME_THRESHOLD_LINE % (threshold, minutes)),
        F.lit(VOLUME_REGIONS_TITLE),
    ]
    heads = hot.select("window_end").distinct().select(
        "window_end", F.posexplode(F.array(*head)).alias("line", "text")
    ).withColumn("line", F.col("line") + 1)
    order = Window.partitionBy("window_end").orderBy(F.desc(value), "region")
    regions = hot.withColumn("line", F.row_number().over(order) + len(head)).select(
        "window_end", "line", F.format_string(VOLUME_REGION_LINE, "region", value, F.lit(minutes)).alias("text")
    )
    return heads.unionByName(regions)


def format_share_alert(
    shares: DataFrame, threshold: float = SEVERE_SHARE_THRESHOLD, t: str = "window_end"
) -> DataFrame:
    """Add the ``message`` of each severe-share alert, stamped with the end of its window."""
    share = F.format_string(SHARE_LINE, _fixed(F.col("percentage"), 1), F.lit(f"{threshold:.1f}"))
    return shares.withColumn("message", _message(SHARE_TITLE, _time_line(t), share))
