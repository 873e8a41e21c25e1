"""Replay the events table through the streaming operators.

A bounded replay reads ``events.parquet`` (a file, or a folder of part files) as
a file stream. An ``availableNow`` run never moves the watermark past
``max(ts) - delay``, so open windows and sessions would never close. The data
is therefore run to its end first, in as many micro-batches as it takes; then a
one-row *flush* file under a reserved key with a far-future time is added and
the query is restarted on the same checkpoint, which moves the watermark past
every timer. (Read earlier, the flush row would make all later rows late.) The
reserved key's own output is dropped.

Results go to a parquet sink with the stream checkpoint next to it, in a folder
of the caller's choice or a new one in the shared checkpoint folder, and are
read back as a batch DataFrame, so nothing passes through the driver. A replay
that is called again with its folder resumes from its checkpoint.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronokey import queries as Q
from chronokey.session import checkpoint_dir
from chronokey.sources.tables import EVENT_SCHEMA, read_events
from chronokey.streaming import operators as S
from chronokey.streaming.revised import (
    ArrivalMeanStream, CappedSessionStream, GapSessionStream, InactivityAlertStream, LateAuditStream, TerminatedSessionStream, _Revised,
)

FLUSH_KEY = -(2**63)  # reserved user_id of the flush row
FLUSH_TS = dt.datetime(2200, 1, 1)
REPLAY_DELAY = "1 hour"


MAX_FILES_PER_TRIGGER = None


def _flush_folder(spark: SparkSession, path: str) -> None:
    """An empty table that the flush row is added to later."""
    spark.createDataFrame([], EVENT_SCHEMA).write.mode("ignore").parquet(path)


def add_flush(spark: SparkSession, path: str) -> None:
    """Add the flush row, once."""
    if spark.read.schema(EVENT_SCHEMA).parquet(path).isEmpty():
        row = spark.createDataFrame([(-1, FLUSH_TS, FLUSH_KEY, None, None, None)], EVENT_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(path)


def events_stream(
    spark: SparkSession,
    sf_dir: str,
    columns: list[str],
    flush_dir: str | None = None,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """``events`` as a streaming DataFrame (``ts`` as UTC TIMESTAMP), plus what
    is in ``flush_dir`` when given. ``max_files_per_trigger`` bounds each
    micro-batch, so a large table replays as many bounded batches."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A glob matches a file and a folder of part files alike.
    src = reader.parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    if flush_dir is not None:
        _flush_folder(spark, flush_dir)
        src = src.unionByName(spark.readStream.schema(EVENT_SCHEMA).parquet(flush_dir))
    return src.select(*columns).withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_completion(spark: SparkSession, sdf: DataFrame, folder: str, progress: list | None = None) -> DataFrame:
    """Run an append-mode streaming DataFrame until the input is drained.
    ``progress`` (a list) receives the finished query for inspection."""
    query = (
        sdf.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if progress is not None:
        progress.append(query)
    return spark.read.schema(sdf.schema).parquet(f"{folder}/out")


def dropped_by_watermark(query) -> int:
    """Rows the stateful operators of a finished query dropped as late, from
    its progress reports (``numRowsDroppedByWatermark``): the streaming
    counterpart of :func:`chronokey.operators.late.late_audit`."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p.get("stateOperators", [])
    )


def replay(
    spark: SparkSession, sf_dir: str, name: str, columns: list[str], build: Callable[[DataFrame], DataFrame],
    folder: str | None = None, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER, progress: list | None = None,
) -> DataFrame:
    """Run the table to its end, then the flush, and return the output."""
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/replays/{name}-{uuid.uuid4().hex}"
    flush = f"{folder}/flush"
    run_to_completion(spark, build(events_stream(spark, sf_dir, columns, flush, max_files_per_trigger)), folder, progress)
    add_flush(spark, flush)
    out = run_to_completion(spark, build(events_stream(spark, sf_dir, columns, flush, max_files_per_trigger)), folder, progress)
    return out.filter(F.col(Q.KEY) != F.lit(FLUSH_KEY))


def q_stream_tumbling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = replay(spark, sf_dir, "tumbling_mean", [Q.KEY, "ts", "value"],
               lambda s: S.stream_tumbling_mean(s, Q.KEY, "ts", "value", Q.DAY, REPLAY_DELAY))
    return Q.project_means(r)


def q_stream_arrival_window_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(s: DataFrame) -> DataFrame:
        return S.stream_arrival_window_mean(Q.with_arrival(s), Q.KEY, "ts", "value", Q.ARRIVAL, Q.DAY, REPLAY_DELAY)

    return Q.project_means(replay(spark, sf_dir, "arrival_window_mean", [Q.KEY, Q.SEQ, "ts", "value"], build))


def q_stream_inactivity_alerts_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = replay(spark, sf_dir, "inactivity_alerts", [Q.KEY, Q.SEQ, "ts"],
               lambda s: S.stream_inactivity_alerts(s, Q.KEY, "ts", Q.SEQ, Q.IDLE, "event", REPLAY_DELAY, revise=True))
    return Q.project_alerts(S.revised_alerts(r, Q.KEY))


def q_stream_sensor_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(s: DataFrame) -> DataFrame:
        return S.stream_sensor_monitor(Q.with_arrival(s), Q.KEY, "ts", "value", Q.ARRIVAL, Q.DAY, Q.IDLE, REPLAY_DELAY)

    r = replay(spark, sf_dir, "sensor_monitor", [Q.KEY, Q.SEQ, "ts", "value"], build)
    return Q.project_monitor(r)


def q_stream_capped_sessions_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = replay(spark, sf_dir, "capped_sessions", [Q.KEY, Q.SEQ, "ts"],
               lambda s: S.stream_capped_sessions(s, Q.KEY, "ts", Q.SEQ, Q.GAP, Q.MAX_LEN, "event_time", REPLAY_DELAY))
    return Q.project_capped(r)


def q_stream_early_count_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = replay(spark, sf_dir, "early_count", [Q.KEY, Q.SEQ, "ts"],
               lambda s: S.stream_early_count(s, Q.KEY, "ts", Q.SEQ, Q.WEEK, Q.EARLY_N, True, False, REPLAY_DELAY))
    return Q.project_early(r)


def q_stream_terminated_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = replay(spark, sf_dir, "terminated_sessions", [Q.KEY, Q.SEQ, "ts", "event_type"],
               lambda s: S.stream_terminated_sessions(s, Q.KEY, "ts", Q.SEQ, "event_type", Q.GAP, Q.EVENT_TERMINATORS,
                                                      REPLAY_DELAY))
    return Q.project_terminated(r)


def q_stream_gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = replay(spark, sf_dir, "gap_sessions", [Q.KEY, "ts"],
               lambda s: S.stream_gap_sessions(s, Q.KEY, "ts", Q.GAP, REPLAY_DELAY))
    return Q.project_gap(r)


# ---- streams that keep every row: the table is fed in the order of its disordered arrival ----

FEED_PARTS = 3


def fed_by_arrival(spark: SparkSession, sf_dir: str, name: str, columns: list[str], build: Callable[[SparkSession, str], _Revised],
                   folder: str | None = None, parts: int = FEED_PARTS) -> _Revised:
    """Feed ``events`` to a stream that keeps every row: in ``parts`` steps of arrival time, each a run of the
    query that resumes from its checkpoint, then the end of the input. The parts' rows overlap in event time by far
    more than the delay."""
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/replays/{name}-{uuid.uuid4().hex}"
    ev = Q.with_arrival(read_events(spark, sf_dir, columns))
    cuts = ev.agg(F.percentile_approx("arrival_us", [k / parts for k in range(1, parts)])).first()[0] or []
    op = build(spark, folder)
    # One part is there at a time, as a stream's source would fill up.
    bounds = [None, *sorted(set(cuts)), None]
    for k, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        part = ev
        if lo is not None:
            part = part.filter(F.col("arrival_us") > lo)
        if hi is not None:
            part = part.filter(F.col("arrival_us") <= hi)
        part.write.mode("overwrite").parquet(f"{folder}/feed/part={k}")
        op.run(spark.readStream.schema(ev.schema).option("basePath", f"{folder}/feed").parquet(f"{folder}/feed/part=*"))
    op.flush()
    return op


def _key_type(spark: SparkSession, sf_dir: str):
    return read_events(spark, sf_dir, [Q.KEY, "ts"]).schema[Q.KEY].dataType


def q_stream_arrival_window_mean_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    key_type = _key_type(spark, sf_dir)
    op = fed_by_arrival(spark, sf_dir, "arrival_mean_late", [Q.KEY, Q.SEQ, "ts", "value"], lambda s, folder: ArrivalMeanStream(
        s, folder, key_type, Q.KEY, "ts", "value", Q.ARRIVAL, Q.DAY))
    return Q.project_means(op.output())


def q_stream_late_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = Q.with_arrival(read_events(spark, sf_dir, [Q.KEY, Q.SEQ, "ts"])).schema
    op = fed_by_arrival(spark, sf_dir, "late_audit", [Q.KEY, Q.SEQ, "ts"], lambda s, folder: LateAuditStream(
        s, folder, schema, Q.KEY, "ts", Q.ARRIVAL, Q.LATE_DELAY, Q.DAY))
    return Q.project_late(op.output())


def q_stream_capped_sessions_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    key_type = _key_type(spark, sf_dir)
    op = fed_by_arrival(spark, sf_dir, "capped_late", [Q.KEY, Q.SEQ, "ts"], lambda s, folder: CappedSessionStream(
        s, folder, key_type, Q.KEY, "ts", Q.SEQ, Q.GAP, Q.MAX_LEN, REPLAY_DELAY))
    return Q.project_capped(op.latest())


def q_stream_gap_sessions_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    key_type = _key_type(spark, sf_dir)
    op = fed_by_arrival(spark, sf_dir, "gap_late", [Q.KEY, Q.SEQ, "ts"], lambda s, folder: GapSessionStream(
        s, folder, key_type, Q.KEY, "ts", Q.SEQ, Q.GAP, REPLAY_DELAY))
    return Q.project_gap(op.latest())


def _project_alerts(r: DataFrame) -> DataFrame:
    """Of these alerts the row that ends the silence isn't kept."""
    return r.select(Q.KEY, *[F.unix_micros(c).alias(f"{c}_us") for c in ("last_seen", "alert_time")], "idle_seconds")


def q_stream_inactivity_alerts_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    key_type = _key_type(spark, sf_dir)
    op = fed_by_arrival(spark, sf_dir, "alerts_late", [Q.KEY, Q.SEQ, "ts"], lambda s, folder: InactivityAlertStream(
        s, folder, key_type, Q.KEY, "ts", Q.SEQ, Q.IDLE, REPLAY_DELAY))
    return _project_alerts(op.latest())


def q_stream_terminated_sessions_revised(spark: SparkSession, sf_dir: str) -> DataFrame:
    key_type = _key_type(spark, sf_dir)
    op = fed_by_arrival(spark, sf_dir, "terminated_revised", [Q.KEY, Q.SEQ, "ts", "event_type"], lambda s, folder: TerminatedSessionStream(
        s, folder, key_type, Q.KEY, "ts", Q.SEQ, "event_type", Q.GAP, Q.EVENT_TERMINATORS, REPLAY_DELAY))
    return Q.project_terminated(op.latest())


#: Streams that keep every row, fed in several steps.
FED_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_arrival_window_mean_late": q_stream_arrival_window_mean_late,
    "stream_late_audit": q_stream_late_audit,
    "stream_capped_sessions_late": q_stream_capped_sessions_late,
    "stream_gap_sessions_late": q_stream_gap_sessions_late,
    "stream_inactivity_alerts_late": q_stream_inactivity_alerts_late,
    "stream_terminated_sessions_revised": q_stream_terminated_sessions_revised,
}

STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_tumbling_mean": q_stream_tumbling_mean,
    "stream_arrival_window_mean": q_stream_arrival_window_mean,
    "stream_inactivity_alerts_open": q_stream_inactivity_alerts_open,
    "stream_sensor_monitor": q_stream_sensor_monitor,
    "stream_capped_sessions_event_time": q_stream_capped_sessions_event_time,
    "stream_early_count_final": q_stream_early_count_final,
    "stream_terminated_sessions": q_stream_terminated_sessions,
    "stream_gap_sessions": q_stream_gap_sessions,
    **FED_QUERIES,
}
