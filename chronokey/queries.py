"""The registered queries: every operator run over the whole ``events`` table.

Parameters follow FIXTURES.md F5 (the demo's second-scale thresholds are
meaningless on events that are hours apart). Times are returned as epoch
microseconds (``*_us``) and lists as comma-joined text so that results
compare exactly with the DuckDB oracles in :mod:`chronokey.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronokey.functions.time import epoch_us
from chronokey.operators.alerts import inactivity_alerts, sensor_monitor
from chronokey.operators.late import late_audit
from chronokey.operators.render import render
from chronokey.operators.sessions import capped_sessions, gap_sessions, terminated_session_rows, terminated_sessions
from chronokey.operators.triggers import early_count
from chronokey.operators.windows import arrival_window_mean, tumbling_mean
from chronokey.sources.tables import read_events

# ---- fixed values: query parameters on the events table (FIXTURES.md F5) ----
DAY = "1 day"
WEEK = "7 days"
GAP = "12 hours"
MAX_LEN = "36 hours"
IDLE = "24 hours"
LATE_DELAY = "5 hours"
EARLY_N = 5
LATE_DROPPED_N = 2
EVENT_TERMINATORS = ("purchase", "error")
ARRIVAL_SHIFT_MULT = 7919  # arrival = ts + pmod(event_id * 7919, 13) hours
ARRIVAL_SHIFT_MOD = 13
# ---- end of fixed values ----

KEY = "user_id"
SEQ = "event_id"
ARRIVAL = ["arrival_us", SEQ]


def _us(c) -> Column:
    return F.unix_micros(F.col(c) if isinstance(c, str) else c)


def _joined(c: str, fn=lambda x: x) -> Column:
    return F.array_join(F.transform(c, lambda x: fn(x).cast("string")), ",")


def with_arrival(ev: DataFrame) -> DataFrame:
    """Derived disordered arrival time, used by the arrival-order operators."""
    shift = F.pmod(F.col(SEQ) * F.lit(ARRIVAL_SHIFT_MULT), F.lit(ARRIVAL_SHIFT_MOD)) * F.lit(3_600_000_000)
    return ev.withColumn("arrival_us", epoch_us("ts") + shift)


def project_means(r: DataFrame) -> DataFrame:
    return r.select(
        KEY,
        _us("window_start").alias("window_start_us"),
        _us("window_end").alias("window_end_us"),
        "n",
        F.round("mean", 6).alias("mean"),
    )


def q_tumbling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, "ts", "value"])
    return project_means(tumbling_mean(ev, KEY, "ts", "value", DAY))


def q_arrival_window_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = with_arrival(read_events(spark, sf_dir, [KEY, SEQ, "ts", "value"]))
    return project_means(arrival_window_mean(ev, KEY, "ts", "value", ARRIVAL, DAY))


def _alerts(spark: SparkSession, sf_dir: str, include_open: bool) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, SEQ, "ts"])
    return project_alerts(inactivity_alerts(ev, KEY, "ts", SEQ, IDLE, include_open))


def project_alerts(r: DataFrame) -> DataFrame:
    return r.select(
        KEY,
        _us("last_seen").alias("last_seen_us"),
        _us("alert_time").alias("alert_time_us"),
        F.col("idle_seconds").cast("long").alias("idle_seconds"),
        _us("next_seen").alias("next_seen_us"),
    )


def q_inactivity_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, False)


def q_inactivity_alerts_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, True)


def q_sensor_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = with_arrival(read_events(spark, sf_dir, [KEY, SEQ, "ts", "value"]))
    return project_monitor(sensor_monitor(ev, KEY, "ts", "value", ARRIVAL, DAY, IDLE))


def q_sensor_monitor_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silences in arrival time, which stands for processing time; means as above."""
    ev = with_arrival(read_events(spark, sf_dir, [KEY, SEQ, "ts", "value"]))
    return project_monitor(sensor_monitor(ev, KEY, "ts", "value", ARRIVAL, DAY, IDLE, time_col="arrival_us"))


def project_monitor(r: DataFrame) -> DataFrame:
    return r.select(KEY, "kind", _us("at").alias("at_us"), F.round("value", 6).alias("value"), "n")


def _capped(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, SEQ, "ts"])
    return project_capped(capped_sessions(ev, KEY, "ts", SEQ, GAP, MAX_LEN, mode))


def project_capped(r: DataFrame) -> DataFrame:
    return r.select(
        KEY,
        _us("session_start").alias("session_start_us"),
        _us("session_end").alias("session_end_us"),
        "n",
        _joined("timestamps", F.unix_micros).alias("timestamps_us"),
        "reason",
    )


def q_capped_sessions_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capped(spark, sf_dir, "arrival")


def q_capped_sessions_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capped(spark, sf_dir, "event_time")


def q_capped_sessions_disordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows taken in their disordered arrival."""
    ev = with_arrival(read_events(spark, sf_dir, [KEY, SEQ, "ts"]))
    return project_capped(capped_sessions(ev, KEY, "ts", ARRIVAL, GAP, MAX_LEN, order="arrival"))


def _early(spark: SparkSession, sf_dir: str, include_final: bool) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, SEQ, "ts"])
    return project_early(early_count(ev, KEY, "ts", SEQ, WEEK, EARLY_N, include_final))


def project_early(r: DataFrame) -> DataFrame:
    return r.select(KEY, _us("window_start").alias("window_start_us"), _us("window_end").alias("window_end_us"), "count", "pane")


def q_early_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _early(spark, sf_dir, False)


def q_early_count_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _early(spark, sf_dir, True)


def q_late_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = with_arrival(read_events(spark, sf_dir, [KEY, SEQ, "ts"]))
    return project_late(late_audit(ev, KEY, "ts", ARRIVAL, LATE_DELAY, DAY))


def project_late(r: DataFrame) -> DataFrame:
    return r.select(
        KEY, SEQ, _us("ts").alias("ts_us"), _us("watermark_before").alias("watermark_before_us"), "is_late"
    )


def q_terminated_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, SEQ, "ts", "event_type"])
    return project_terminated(terminated_sessions(ev, KEY, "ts", SEQ, "event_type", GAP, EVENT_TERMINATORS))


def project_terminated(r: DataFrame) -> DataFrame:
    return r.select(
        KEY,
        _us("session_start").alias("session_start_us"),
        _us("session_end").alias("session_end_us"),
        "segment",
        F.array_join("event_types", ",").alias("event_types"),
        "closed_by",
    )


def q_terminated_session_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, SEQ, "ts", "event_type"])
    r = terminated_session_rows(ev, KEY, "ts", SEQ, "event_type", GAP, EVENT_TERMINATORS)
    return r.select(KEY, SEQ, _us("ts").alias("ts_us"), "event_type", _us("session_start").alias("session_start_us"), "segment", "position")


def q_gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, SEQ, "ts"])
    return project_gap(gap_sessions(ev, KEY, "ts", SEQ, GAP))


def project_gap(r: DataFrame) -> DataFrame:
    return r.select(KEY, _us("session_start").alias("session_start_us"), _us("session_end").alias("session_end_us"), "n")


def q_terminated_session_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, SEQ, "ts", "event_type"])
    r = render(terminated_sessions(ev, KEY, "ts", SEQ, "event_type", GAP, EVENT_TERMINATORS), "terminated_sessions", KEY)
    return r.select(KEY, _us("session_start").alias("session_start_us"), "segment", "message")


def q_capped_session_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, SEQ, "ts"])
    r = render(capped_sessions(ev, KEY, "ts", SEQ, GAP, MAX_LEN, "arrival"), "capped_sessions", KEY)
    return r.select(KEY, _us("session_start").alias("session_start_us"), "message")


def q_mean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, "ts", "value"])
    means = tumbling_mean(ev, KEY, "ts", "value", DAY).withColumn("mean", F.round("mean", 6))
    return render(means, "mean", KEY).select(KEY, _us("window_end").alias("window_end_us"), "message")


def q_alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, SEQ, "ts"])
    r = render(inactivity_alerts(ev, KEY, "ts", SEQ, IDLE, False), "alert", KEY)
    return r.select(KEY, _us("last_seen").alias("last_seen_us"), "message")


def q_early_count_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_events(spark, sf_dir, [KEY, SEQ, "ts"])
    r = render(early_count(ev, KEY, "ts", SEQ, WEEK, EARLY_N, True), "early_count", KEY)
    return r.select(KEY, _us("window_start").alias("window_start_us"), "pane", "count", "message")


def q_monitor_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = with_arrival(read_events(spark, sf_dir, [KEY, SEQ, "ts", "value"]))
    r = sensor_monitor(ev, KEY, "ts", "value", ARRIVAL, DAY, IDLE).withColumn("value", F.round("value", 6))
    return render(r, "monitor", KEY).select(KEY, "kind", _us("at").alias("at_us"), "message")


def q_early_count_late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = with_arrival(read_events(spark, sf_dir, [KEY, SEQ, "ts"]))
    return project_early(early_count(ev, KEY, "ts", ARRIVAL, DAY, LATE_DROPPED_N, True, delay=LATE_DELAY))


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tumbling_mean": q_tumbling_mean,
    "arrival_window_mean": q_arrival_window_mean,
    "inactivity_alerts": q_inactivity_alerts,
    "inactivity_alerts_open": q_inactivity_alerts_open,
    "sensor_monitor": q_sensor_monitor,
    "sensor_monitor_arrival": q_sensor_monitor_arrival,
    "capped_sessions_arrival": q_capped_sessions_arrival,
    "capped_sessions_event_time": q_capped_sessions_event_time,
    "capped_sessions_disordered": q_capped_sessions_disordered,
    "early_count": q_early_count,
    "early_count_final": q_early_count_final,
    "late_audit": q_late_audit,
    "terminated_sessions": q_terminated_sessions,
    "terminated_session_rows": q_terminated_session_rows,
    "gap_sessions": q_gap_sessions,
    "terminated_session_messages": q_terminated_session_messages,
    "capped_session_messages": q_capped_session_messages,
    "mean_messages": q_mean_messages,
    "alert_messages": q_alert_messages,
    "early_count_messages": q_early_count_messages,
    "monitor_messages": q_monitor_messages,
    "early_count_late_dropped": q_early_count_late_dropped,
}
