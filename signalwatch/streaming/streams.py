"""Streaming forms of the operators, and how queries are started."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from signalwatch.functions import seconds
from signalwatch.operators.matching import _MICROS, _at, _distinct_names
from signalwatch.operators.quality import DEFAULT_RULES, run_dq, schema_flags
from signalwatch.operators.timeseries import tumbling_counts
from signalwatch.session import ROCKSDB_PROVIDER, session_conf
from signalwatch.sources.sinks import BatchSink

TRIGGER = "30 seconds"


def start_stream(
    df: DataFrame,
    sink: BatchSink,
    name: str,
    checkpoint: str,
    mode: str = "append",
    trigger: str | None = TRIGGER,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a named query with a checkpoint of its own, so that a restart resumes it.

    ``trigger`` is an interval, ``"availableNow"`` to process what there is and stop, or ``None`` for
    as fast as possible.  A stateful query keeps the number of shuffle partitions of its first start;
    ``state_partitions`` sets it there (adaptive execution does not change it later).
    """
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        # sessions of a hot key are merged in each task before they are shuffled
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    writer = (
        df.writeStream.outputMode(mode).queryName(name)
        .option("checkpointLocation", checkpoint).foreachBatch(sink)
    )
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    elif trigger is not None:
        writer = writer.trigger(processingTime=trigger)
    with session_conf(df.sparkSession, settings):
        return writer.start()


def await_any(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until one of the queries ends, stop the others, and raise the error of one that failed.

    Other queries of the session may come and go meanwhile.
    """
    try:
        while all(query.isActive for query in queries):
            spark.streams.resetTerminated()
            if all(query.isActive for query in queries):
                spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    for query in queries:
        error = query.exception()
        if error is not None:
            raise error


def windowed_stream(
    df: DataFrame, t: str, width: str, by: list[str] = (), lateness: str = "10 minutes"
) -> DataFrame:
    """Tumbling counts whose windows leave the state once ``lateness`` has passed.

    In append mode a window is written when it is final, so the newest are not written until later events
    come.  In update mode every change is written; ``sinks.read_latest`` then has all windows at any
    time, and sliding windows are sums over these (``timeseries.sliding_counts``), so that the state
    holds each slide once.  Events later than the lateness are counted by ``late_rows``.
    """
    return tumbling_counts(df.withWatermark(t, lateness), t, width, by)


def sliding_stream(
    df: DataFrame, t: str, width: str, slide: str, by: list[str] = (),
    lateness: str = "10 minutes",
) -> DataFrame:
    """Counts of the last ``width`` at the end of every ``slide``, final after ``lateness``.

    Events are counted once per slide; only these counts, not the events, are copied into the windows
    that cover them.
    """
    per_slide = (
        df.withWatermark(t, lateness)
        .groupBy(F.window(t, slide).alias("_slide"), *by)
        .agg(F.count("*").alias("_events"))
    )
    return (
        per_slide.groupBy(F.window(F.window_time("_slide"), width, slide), *by)
        .agg(F.sum("_events").alias("event_count"))
        .select(
            *by, F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"), "event_count",
        )
    )


def session_stream(
    df: DataFrame, t: str, gap: str, by: list[str] = (), lateness: str = "10 minutes"
) -> DataFrame:
    """Events per session, as ``timeseries.session_counts``; a session is final, and comes out in append mode,
    when the watermark has passed its end.  Events that arrive between two open sessions merge them."""
    return (
        df.where(F.col(t).isNotNull()).withWatermark(t, lateness)
        .groupBy(F.session_window(t, gap).alias("_session"), *by)
        .agg(F.count("*").alias("event_count"))
        .select(
            *by, F.col("_session.start").alias("session_start"),
            F.col("_session.end").alias("session_end"), "event_count",
        )
    )


def range_join_stream(
    left: DataFrame, right: DataFrame, t: str, right_t: str, by: list[str], before: str,
    after: str | None = None, how: str = "left", lateness: str = "10 minutes",
    right_lateness: str | None = None, packed: bool = False,
) -> DataFrame:
    """``matching.range_join`` of two streams, each with a watermark of its own.

    The rows of a key and block of time (as long as the range) are one row of the state, and so are the right rows that these can
    meet, in order of time; the join is one of these packs, behind which each left row finds where the right rows that it meets
    begin and end.  So the state is read per block, not once for every pair that comes out, and no pair is compared.  A block
    leaves the state, and its rows come out, when no row that is still allowed can meet them.  Both bounds follow the slower
    side.  Rows without a time are left out, and so are rows behind the watermark whose block has left (``late_rows``).

    ``packed=True`` leaves the pairs in their packs, which a table can hold: it grows with the rows, not with the
    pairs.  ``open_packs`` gives the pairs.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how is left or inner: {how!r}")
    by = list(by)
    _distinct_names(left, right, by)
    ahead, behind = seconds(before) * _MICROS, seconds(after) * _MICROS if after else 0
    width = ahead + behind
    # windows begin ``ahead`` before a block and end ``behind`` after it
    windows = [f"{n} microseconds" for n in (ahead + width + behind, width, -ahead % width)]

    def grouped(df: DataFrame, at: str, delay: str, wanted: Column, name: str) -> DataFrame:
        rows = df.where(F.col(at).isNotNull()).withWatermark(at, delay)
        rows = rows.select(
            F.window(at, *windows).alias(f"_{name}_window"), *[F.col(k).alias(f"_{name}_{k}") for k in by],
            F.struct(_at(at).alias("_at"), F.struct(*df.columns).alias("row")).alias("_row"),
        )
        keys = [c for c in rows.columns if c != "_row"]
        return rows.where(wanted).groupBy(*keys).agg(F.collect_list("_row").alias(f"_{name}_rows"))

    since = F.col("_row._at") - F.unix_micros(F.col("_left_window.start").cast("timestamp")) - ahead
    lefts = grouped(left, t, lateness, (since >= 0) & (since < width), "left")
    has_keys = reduce(lambda a, b: a & b, [F.col(f"_right_{k}").isNotNull() for k in by], F.lit(True))
    rights = grouped(right, right_t, right_lateness or lateness, has_keys, "right")
    # each column as an array in order of time
    own = [c for c in right.columns if c not in by]
    order = F.array_sort(F.transform("_right_rows", lambda r, i: F.struct(r["_at"].alias("at"), i.alias("i"))))
    ordered = lambda c: F.transform("_order", lambda o: F.get("_right_rows", o["i"])["row"][c])
    rights = rights.withColumn("_order", order).select(
        *[f"_right_{c}" for c in ("window", *by)], F.col("_order.at").alias("_times"), *[ordered(c).alias(f"{_EACH}{c}") for c in own]
    )
    same = [F.col(f"_left_{c}") == F.col(f"_right_{c}") for c in ("window", *by)]
    packs = lefts.join(rights, same, "left_outer" if how == "left" else "inner")

    def met(row: Column) -> Column:
        start, end = _earlier("_times", row["_at"] - ahead), _earlier("_times", row["_at"] + behind + 1)
        return F.struct(row["row"].alias("row"), start.alias("start"), end.alias("end"))

    packs = packs.select(F.transform("_left_rows", met).alias("_lefts"), *[f"{_EACH}{c}" for c in own])
    return packs if packed else open_packs(packs, how)


_EACH = "_each_"


def _earlier(times: str, at: Column) -> Column:
    """How many of the ordered times lie before ``at``, by halving."""
    steps = F.sequence(F.floor(F.log2(F.size(times))).cast("int"), F.lit(0), F.lit(-1))
    further = lambda n, k: n + F.call_function("shiftleft", F.lit(1), k)
    return F.when(
        F.size(times) > 0,
        F.aggregate(steps, F.lit(0), lambda n, k: F.when(F.get(times, further(n, k) - 1) < at, further(n, k)).otherwise(n)),
    ).otherwise(0)


def open_packs(packs: DataFrame, how: str = "left") -> DataFrame:
    """The pairs of the packs that ``range_join_stream`` gives with ``packed=True``.

    Left rows are taken from their pack one by one, so a task holds the pairs of a left row at once, not those of a pack.
    """
    each = [c for c in packs.columns if c.startswith(_EACH)]
    # a lambda keeps this step out of generated code, which would hand out nothing before the last pair of a pack
    spans = F.transform("_lefts", lambda x: F.struct(x["row"].alias("row"), x["start"].alias("start"), (x["end"] - 1).alias("last")))
    lefts = packs.select(F.explode(spans).alias("_left"), *each).select(
        "_left.row.*", F.col("_left.start").alias("_start"), F.col("_left.last").alias("_last"), *each
    )
    own = [c for c in lefts.columns if c not in ("_start", "_last", *each)]
    # places, not rows: a pair costs a read per column
    places = F.when(F.col("_last") >= F.col("_start"), F.sequence("_start", "_last"))
    pairs = lefts.select(*own, *each, (F.explode_outer if how == "left" else F.explode)(places).alias("_place"))
    return pairs.select(*own, *[F.get(c, F.col("_place")).alias(c[len(_EACH):]) for c in each])


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were left out, as far as the query's progress is kept."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress for operator in progress.stateOperators
    )


def dedup_stream(df: DataFrame, key: str, t: str, lateness: str = "10 minutes") -> DataFrame:
    """Drop replayed events; ids are remembered for ``lateness`` of event time only."""
    return df.withWatermark(t, lateness).dropDuplicatesWithinWatermark([key])


def start_dq_stream(
    df: DataFrame, sink: BatchSink, name: str, checkpoint: str, rules: dict = DEFAULT_RULES,
    trigger: str | None = TRIGGER, decoded: list[str] | None = None, text_time: str | None = None,
) -> StreamingQuery:
    """Store the quality metrics of each micro-batch, computed in one pass over it.

    With ``decoded``, the columns that come out of decoding, undecodable rows are counted too, and with
    ``text_time`` also times that could not be read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if decoded:
            batch = schema_flags(batch, decoded, text_time)
        sink(run_dq(batch, rules), batch_id)

    return start_stream(df, write, name, checkpoint, trigger=trigger)


def cooldown_stream(
    df: DataFrame, t: str, keys: list[str], minutes: float, lateness: str = "10 minutes"
) -> DataFrame:
    """``apply_cooldown`` for a stream of alerts that arrives in time order.

    The state is one time per key and leaves when the watermark passes the end of the cooldown: a
    later alert would fire anyway.  ``keys=[]`` is one clock for all alerts.
    """
    pause = int(minutes * 60_000_000)
    columns = df.columns
    schema: StructType = df.schema

    def fire(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        alerts = pd.concat(list(frames)).sort_values(t, kind="stable")
        times = alerts[t].astype("datetime64[us]").astype("int64")
        last = state.get[0] if state.exists else None
        fired = []
        for at in times:
            if last is None or at - last >= pause:
                last = at
            fired.append(at == last)
        end = (last + pause) // 1000 + 1
        if end > state.getCurrentWatermarkMs():
            state.update((last,))
            state.setTimeoutTimestamp(end)
        elif state.exists:
            state.remove()
        yield alerts[fired][columns]

    clocks = df.withWatermark(t, lateness)
    if not keys:
        clocks, keys = clocks.withColumn("_clock", F.lit(0)), ["_clock"]
    return (
        clocks.groupBy(*keys)
        .applyInPandasWithState(
            fire, schema, "last bigint", "append", GroupStateTimeout.EventTimeTimeout
        )
    )


class _Clock(StatefulProcessor):
    """Fires a key's instants in order of time, however they arrive.

    The state is the last instant that fired and those that wait for the watermark; a timer at the earliest one
    settles all that the watermark has passed.
    """

    def __init__(self, pause: int, keys: list[str], t: str):
        self.pause, self.keys, self.t = pause, keys, t

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at bigint")
        self.waiting = handle.getListState("waiting", "at bigint")

    def handleInputRows(self, key, rows, timerValues):
        earliest = None
        for frame in rows:
            times = frame[self.t].astype("datetime64[us]").astype("int64").unique()
            if len(times):
                self.waiting.appendList([(int(at),) for at in times])
                earliest = min(times.min(), earliest) if earliest is not None else times.min()
        if earliest is not None:
            self.handle.registerTimer(_millis(int(earliest)))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        times = sorted({at for (at,) in self.waiting.get()})
        due = [at for at in times if at <= passed]
        later = times[len(due):]
        if later:
            self.waiting.put([(at,) for at in later])
            self.handle.registerTimer(_millis(later[0]))
        else:
            self.waiting.clear()
        last = self.last.get()[0] if self.last.exists() else None
        fired = []
        for at in due:
            if last is None or at - last >= self.pause:
                last = at
                fired.append(at)
        if fired:
            self.last.update((last,))
            frame = pd.DataFrame({self.t: pd.to_datetime(fired, unit="us")})
            for name, value in zip(self.keys, key, strict=True):
                frame[name] = value
            yield frame[[*self.keys, self.t]]

    def close(self) -> None:
        pass


def _millis(at: int) -> int:
    """The first millisecond that is not before a time in microseconds."""
    return -(-at // 1000)


def fired_instants_stream(
    df: DataFrame, t: str, keys: list[str], minutes: float, lateness: str = "10 minutes"
) -> DataFrame:
    """The (keys, t) at which alerts fire after the cooldown, for alerts that arrive in any order within ``lateness``.

    Equal to ``alerts.apply_cooldown`` on the table of all alerts but late ones.  An instant is settled when
    the watermark has passed it, so none that may still come can change what fires.  Alerts of an instant are reduced
    to one row by tasks that share them by key and time, so the clock of a key, also the only one of ``keys=[]``,
    sees a row per instant, not the alerts.  The last instant that fired stays in the state: an
    alert may come after any pause.
    """
    pause = int(minutes * 60_000_000)
    clocks, keys = df.where(F.col(t).isNotNull()).withWatermark(t, lateness), list(keys)
    if not keys:
        clocks, keys = clocks.withColumn("_clock", F.lit(0)), ["_clock"]
    instants = clocks.select(*keys, t).dropDuplicatesWithinWatermark([*keys, t])
    schema = StructType([instants.schema[c] for c in (*keys, t)])
    settled = instants.groupBy(*keys).transformWithStateInPandas(
        _Clock(pause, keys, t), schema, "Append", "EventTime", eventTimeColumnName=t
    )
    return settled.drop("_clock")


def settled_cooldown_stream(
    df: DataFrame, t: str, keys: list[str], minutes: float, lateness: str = "10 minutes"
) -> DataFrame:
    """``alerts.apply_cooldown`` for a stream of alerts in any order: all columns of the alerts that fire.

    The instants that fire are joined with the alerts, which wait for them dealt by key and time.
    """
    fired = fired_instants_stream(df, t, keys, minutes, lateness)
    names = {c: f"_fired_{c}" for c in (*keys, t)}
    same = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys]
    alerts = df.where(F.col(t).isNotNull()).withWatermark(t, lateness)
    joined = alerts.join(fired.withColumnsRenamed(names), [F.col(t) == F.col(names[t]), *same])
    return joined.drop(*names.values())
