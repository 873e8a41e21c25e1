"""Streaming forms of the operators: streaming DataFrame in, streaming DataFrame out.

``ts`` must be a ``TIMESTAMP`` column; each function sets the watermark
(``delay`` of allowed disorder) itself. Outputs have the same columns and
types as the batch operators and are meant for ``outputMode("append")``.
J1 and J9 are plain streaming aggregates; the others run a per-key state
function under ``applyInPandasWithState`` with an event-time timeout
(processing-time for live inactivity alerts), see ``stateful.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from chronokey.functions.time import duration_us, epoch_us, from_epoch_us, window_floor
from chronokey.operators._common import as_list
from chronokey.operators.sessions import CAPPED_GAP, CAPPED_MAX, TERMINATED_GAP, TERMINATORS
from chronokey.operators.triggers import EARLY_N, EARLY_WIDTH
from chronokey.operators.windows import DEFAULT_WIDTH, tumbling_mean
from chronokey.streaming import stateful as ST

DEFAULT_DELAY = "5 seconds"
_L = T.LongType()


def _schema(key_type: T.DataType, fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField("key", key_type), *[T.StructField(n, t) for n, t in fields]])


def _times(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Processor output (key, *_us) -> operator output (key name, timestamps)."""
    out = []
    for c in df.columns:
        if c == "key":
            out.append(F.col("key").alias(key))
        elif c.endswith("_us") and c not in cols:
            out.append(from_epoch_us(c).alias(c[: -len("_us")]))
        else:
            out.append(F.col(c))
    return df.select(*out)


def stream_tumbling_mean(sdf: DataFrame, key="sensor_id", ts="ts", value="temperature", width=DEFAULT_WIDTH, delay=DEFAULT_DELAY):
    """J1 as a streaming aggregate; a window is emitted once the watermark passes its end."""
    return tumbling_mean(sdf.withWatermark(ts, delay), key, ts, value, width)


def stream_gap_sessions(sdf: DataFrame, key="user_id", ts="ts", gap=TERMINATED_GAP, delay=DEFAULT_DELAY):
    """J9 with ``session_window`` (rows exactly ``gap`` apart merge)."""
    w = F.session_window(F.col(ts), f"{duration_us(gap)} microseconds")
    return (
        sdf.withWatermark(ts, delay)
        .groupBy(F.col(key), w.alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
    )


def _stateful(d: DataFrame, key, fn, key_type: T.DataType, columns, out_fields, state_schema: str, timeout: str):
    schema = _schema(key_type, out_fields)
    assert [f.name for f in schema.fields] == columns
    return d.groupBy(*as_list(key)).applyInPandasWithState(fn, schema, state_schema, "append", timeout)


#: Buckets of keys of the early counts. Fixed for the life of a checkpoint.
EARLY_BUCKETS = 1024


def _plain_key(key: str, kind: T.DataType):
    """A key column as long or text, which Python workers hand on unchanged, its type there, and the way back."""
    if isinstance(kind, T.IntegralType):
        return F.col(key).cast("long"), _L, lambda c: F.col(c).cast(kind)
    if isinstance(kind, T.BinaryType):
        return F.base64(key), T.StringType(), lambda c: F.unbase64(c)
    plain = F.col(key) + F.lit(0) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(key)  # -0.0 is 0.0
    return plain.cast("string"), T.StringType(), lambda c: F.col(c).cast(kind)


def stream_early_count(
    sdf: DataFrame, key="user_id", ts="ts", seq="seq", width=EARLY_WIDTH, n=EARLY_N, include_final=True, once=False,
    delay=DEFAULT_DELAY, buckets=EARLY_BUCKETS,
):
    """Grouped by window and bucket of keys (by hash), so that the number of calls does not grow
    with the keys and a key's windows are apart. The input
    carries the time of the window, which holds the watermark, so a row is late only once its window end is behind the watermark (as with a
    windowed aggregate), not as soon as its own time is. Workers put out runs of counts, which become rows in Spark."""
    width_us = duration_us(width)
    plain, kind, back = _plain_key(key, sdf.schema[key].dataType)
    w = F.window(F.col(ts), f"{width_us} microseconds")
    bucket = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64("__key"), F.lit(buckets)).cast("int"))
    d = sdf.withWatermark(ts, delay).select(key, plain.alias("__key"), w.alias("__w"), window_floor(epoch_us(ts), width_us).alias("__ws"))
    d = d.select("__key", F.window_time("__w").alias("__wt"), "__ws", bucket.alias("__b"))
    out = _stateful(
        d, ["__b", "__ws"], ST.early_count_fn(width_us, n, include_final, once), kind, ST.EARLY_COLUMNS,
        [("window_start_us", _L), ("first", _L), ("last", _L), ("pane", T.StringType())], ST.EARLY_STATE.format(kind.simpleString()),
        GroupStateTimeout.EventTimeTimeout,
    )
    return out.select(
        back("key").alias(key), from_epoch_us("window_start_us").alias("window_start"),
        from_epoch_us(F.col("window_start_us") + F.lit(width_us)).alias("window_end"),
        F.explode(F.sequence("first", "last")).alias("count"), "pane")


def stream_arrival_window_mean(
    sdf: DataFrame, key="sensor_id", ts="ts", value="temperature", seq="seq", width=DEFAULT_WIDTH, delay=DEFAULT_DELAY
):
    width_us = duration_us(width)
    order = as_list(seq)
    d = sdf.withWatermark(ts, delay).select(
        key, *order, ts, epoch_us(ts).alias("__us"), F.col(value).cast("double").alias("__value")
    )
    out = _stateful(
        d, key, ST.arrival_mean_fn(width_us, order), sdf.schema[key].dataType, ST.MEAN_COLUMNS,
        [("window_start_us", _L), ("window_end_us", _L), ("n", _L), ("mean", T.DoubleType())], ST.MEAN_STATE,
        GroupStateTimeout.EventTimeTimeout,
    )
    return _times(out, key, [])


def stream_inactivity_alerts(
    sdf: DataFrame, key="sensor_id", ts="ts", seq="seq", threshold="10 seconds", domain="event", delay=DEFAULT_DELAY,
    revise=False,
):
    """Columns key, last_seen, alert_time, idle_seconds, next_seen. ``domain="event"``: event-time
    silence, equal to the batch operator with ``include_open=True`` once the stream is flushed, but
    ``next_seen`` is null where the alert fired before the row that ends the silence had settled.
    ``revise=True`` puts such an alert out again, with ``next_seen``, once that row has settled
    (:func:`revised_alerts` reads the last word of each); a key that has fallen silent for good then keeps its
    state row. ``domain="processing"``: wall-clock timeouts, as in a live monitor (not reproducible)."""
    d = sdf.select(key, ts, F.col(seq).cast("long").alias("__seq"), epoch_us(ts).alias("__us"))
    timeout = GroupStateTimeout.EventTimeTimeout
    if domain == "event":
        d = d.withWatermark(ts, delay)
    else:
        timeout = GroupStateTimeout.ProcessingTimeTimeout
    out = _stateful(
        d, key, ST.inactivity_fn(duration_us(threshold), domain, revise), sdf.schema[key].dataType, ST.ALERT_COLUMNS,
        [("last_seen_us", _L), ("alert_time_us", _L), ("idle_seconds", _L), ("next_seen_us", _L)], ST.ALERT_STATE,
        timeout,
    )
    return _times(out, key, ["idle_seconds"])


def revised_alerts(alerts: DataFrame, key="sensor_id") -> DataFrame:
    """One row for each silence from the output of ``stream_inactivity_alerts(revise=True)``: with ``next_seen`` if it has ended."""
    return alerts.groupBy(key, "last_seen", "alert_time", "idle_seconds").agg(F.max("next_seen").alias("next_seen"))


def stream_terminated_sessions(
    sdf: DataFrame, key="user_id", ts="ts", seq="seq", event_type="event_type", gap=TERMINATED_GAP,
    terminators=TERMINATORS, delay=DEFAULT_DELAY, lists=True,
):
    """J8; a segment is emitted once the watermark has passed its last row (rows
    within the delay may still come before it). ``lists=False``: ``n`` only."""
    d = sdf.withWatermark(ts, delay).select(
        key, ts, F.col(seq).cast("long").alias("__seq"), F.col(event_type).alias("__type"), epoch_us(ts).alias("__us")
    )
    out = _stateful(
        d, key, ST.terminated_session_fn(duration_us(gap), tuple(terminators), lists), sdf.schema[key].dataType,
        ST.TERMINATED_COLUMNS,
        [("session_start_us", _L), ("session_end_us", _L), ("segment", _L), ("event_types", T.ArrayType(T.StringType())),
         ("n", _L), ("closed_by", T.StringType())],
        ST.TERMINATED_STATE, GroupStateTimeout.EventTimeTimeout,
    )
    return _times(out, key, []).drop("n" if lists else "event_types")


def stream_capped_sessions(
    sdf: DataFrame, key="user_id", ts="ts", seq="seq", gap=CAPPED_GAP, max_len=CAPPED_MAX, mode="event_time",
    delay="0 seconds", lists=True,
):
    """J5; ``lists=False`` leaves out ``timestamps`` and keeps the state row small."""
    d = sdf.withWatermark(ts, delay).select(key, ts, F.col(seq).cast("long").alias("__seq"), epoch_us(ts).alias("__us"))
    out = _stateful(
        d, key, ST.capped_session_fn(duration_us(gap), duration_us(max_len), mode, lists), sdf.schema[key].dataType,
        ST.CAPPED_COLUMNS,
        [("session_start_us", _L), ("session_end_us", _L), ("n", _L), ("timestamps", T.ArrayType(_L)), ("reason", T.StringType())],
        ST.CAPPED_STATE, GroupStateTimeout.EventTimeTimeout,
    )
    out = out.withColumn("timestamps", F.transform("timestamps", lambda x: from_epoch_us(x)))
    out = _times(out, key, [])
    return out if lists else out.drop("timestamps")


def stream_sensor_monitor(
    sdf: DataFrame, key="sensor_id", ts="ts", value="temperature", seq="seq", width=DEFAULT_WIDTH,
    threshold="10 seconds", delay=DEFAULT_DELAY,
):
    """J4 as one streaming query: one state function per key computes both the
    arrival-order means and the event-time silences (kind, at, value, n, idle_seconds), as
    the original job did in a single keyed function. A flushed replay also
    reports each key's final silence."""
    order = as_list(seq)
    d = sdf.withWatermark(ts, delay).select(
        key, *[c for c in order if c != key], ts, F.col(order[-1]).cast("long").alias("__seq"), epoch_us(ts).alias("__us"),
        F.col(value).cast("double").alias("__value"),
    )
    out = _stateful(
        d, key, ST.sensor_monitor_fn(duration_us(width), duration_us(threshold), order), sdf.schema[key].dataType,
        ST.MONITOR_COLUMNS,
        [("kind", T.StringType()), ("at_us", _L), ("value", T.DoubleType()), ("n", _L)], ST.MONITOR_STATE,
        GroupStateTimeout.EventTimeTimeout,
    )
    idle = F.when(F.col("kind") == "alert", F.lit(duration_us(threshold) // 1_000_000))
    return _times(out, key, []).withColumn("idle_seconds", idle)


def stream_live_monitor(
    sdf: DataFrame, key="sensor_id", ts="ts", value="temperature", seq="seq", width=DEFAULT_WIDTH,
    threshold="10 seconds", delay=DEFAULT_DELAY,
):
    """J4 in both time domains, as the original job has it: means in event time and wall-clock
    alerts, from one source in one query. Each domain has its own stateful operator (a Spark timer
    has one domain); their outputs are united. A source that pauses raises alerts while
    the means wait for the watermark. Columns as :func:`stream_sensor_monitor`; append mode, with a
    processing-time trigger. Needs the RocksDB state store, which ``get_spark`` sets."""
    means = stream_arrival_window_mean(sdf, key, ts, value, seq, width, delay)
    out = _schema(sdf.schema[key].dataType, [("last_seen_us", _L), ("alert_time_us", _L), ("idle_seconds", _L)])
    rows = sdf.select(key, epoch_us(ts).alias("__us")).filter(F.col("__us").isNotNull())
    alerts = rows.groupBy(key).transformWithState(ST.IdleTimer(duration_us(threshold)), out, "Append", "ProcessingTime")
    alerts = _times(alerts, key, ["idle_seconds"])
    null = lambda t: F.lit(None).cast(t)
    return means.select(
        key, F.lit("mean").alias("kind"), F.col("window_end").alias("at"), F.col("mean").alias("value"), "n", null("long").alias("idle_seconds")
    ).unionByName(alerts.select(
        key, F.lit("alert").alias("kind"), F.col("alert_time").alias("at"), null("double").alias("value"), null("long").alias("n"), "idle_seconds"))
