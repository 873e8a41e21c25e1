"""Streaming forms: multi-batch replays equal the batch operators after a flush."""

import os
import datetime as dt
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chronokey import capped_sessions, early_count, terminated_sessions
from chronokey.session import checkpoint_dir
from chronokey.sources import samples as S
from chronokey.streaming import operators as SO
from chronokey.streaming.replay import run_to_completion

FLUSH = 7258118400000  # 2200-01-01 in ms


def _chunks(rows, parts):
    """Rows (user_id, event_type, ts_ms) with arrival seq, split into ``parts``
    chunks in arrival order; the flush row goes with the last chunk."""
    rows = [(i, k, e, t) for i, (k, e, t) in enumerate(rows)]
    step = max(1, -(-len(rows) // parts))
    chunks = [rows[i : i + step] for i in range(0, len(rows), step)]
    chunks[-1] = chunks[-1] + [(10**6, "~flush", "x", FLUSH)]
    return chunks


def _write(folder, chunks, first_index=0):
    """Each chunk as one parquet file, modification times in chunk order."""
    os.makedirs(folder, exist_ok=True)
    now = time.time() - 100 + first_index
    for i, ch in enumerate(chunks, start=first_index):
        table = pa.table({
            "seq": [r[0] for r in ch], "user_id": [r[1] for r in ch],
            "event_type": [r[2] for r in ch], "ts_ms": [r[3] for r in ch],
        })
        path = f"{folder}/part-{i:03d}.parquet"
        pq.write_table(table, path)
        os.utime(path, (now + i - first_index, now + i - first_index))


def _files(spark, rows, parts):
    folder = f"{checkpoint_dir(spark).removeprefix('file:')}/src-{uuid.uuid4().hex}"
    _write(folder, _chunks(rows, parts))
    return folder


def _stream(spark, folder):
    return (
        spark.readStream.schema("seq long, user_id string, event_type string, ts_ms long")
        .option("maxFilesPerTrigger", 1)
        .parquet(folder)
        .withColumn("ts", F.timestamp_millis("ts_ms"))
    )


def _run(spark, sdf):
    folder = f"{checkpoint_dir(spark).rstrip('/')}/out-{uuid.uuid4().hex}"
    return run_to_completion(spark, sdf, folder).filter(F.col("user_id") != "~flush")


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("parts", [1, 3])
def test_terminated_sessions_replay(spark, parts):
    src = _stream(spark, _files(spark, S.TERMINATED_SESSION_SAMPLE, parts))
    out = _run(spark, SO.stream_terminated_sessions(src, delay="5 seconds"))
    batch = terminated_sessions(S.user_events(spark, S.TERMINATED_SESSION_SAMPLE))
    cols = ["user_id", "session_start", "session_end", "segment", F.array_join("event_types", ","), "closed_by"]
    assert _rows(out, cols) == _rows(batch, cols)


@pytest.mark.parametrize("parts", [1, 3])
def test_capped_sessions_replay(spark, parts):
    src = _stream(spark, _files(spark, S.CAPPED_SESSION_SAMPLE, parts))
    out = _run(spark, SO.stream_capped_sessions(src, delay="0 seconds"))
    batch = capped_sessions(S.user_events(spark, S.CAPPED_SESSION_SAMPLE), mode="event_time")
    cols = ["user_id", "session_start", "session_end", "n", "reason"]
    assert _rows(out, cols) == _rows(batch, cols)


@pytest.mark.parametrize("parts", [1, 4])
def test_early_count_replay(spark, parts):
    src = _stream(spark, _files(spark, S.EARLY_COUNT_SAMPLE, parts))
    out = _run(spark, SO.stream_early_count(src, delay="5 seconds"))
    batch = early_count(S.user_events(spark, S.EARLY_COUNT_SAMPLE))
    cols = ["user_id", "window_start", "count", "pane"]
    assert _rows(out, cols) == _rows(batch, cols)


def test_gap_sessions_replay(spark):
    src = _stream(spark, _files(spark, S.TERMINATED_SESSION_SAMPLE, 2))
    out = _run(spark, SO.stream_gap_sessions(src, gap="15 minutes", delay="5 seconds"))
    assert sorted(r.n for r in out.collect()) == [3, 3, 4]


def test_processing_time_alerts(spark):
    """Live monitor: a processing-time timer per key fires once after silence."""
    sr = S.sensor_readings(spark)
    folder = f"{checkpoint_dir(spark).removeprefix('file:')}/live-{uuid.uuid4().hex}"
    sr.drop("ts").write.parquet(folder)
    src = (
        spark.readStream.schema(sr.drop("ts").schema).parquet(folder).withColumn("ts", F.timestamp_millis("ts_ms"))
    )
    q = (
        SO.stream_inactivity_alerts(src, "sensor_id", "ts", "seq", "1 second", domain="processing")
        .writeStream.format("memory").queryName(f"alerts_{uuid.uuid4().hex[:8]}")
        .outputMode("append").trigger(processingTime="500 milliseconds").start()
    )
    try:
        deadline = time.time() + 30
        while time.time() < deadline:
            if spark.table(q.name).count() >= 2:
                break
            time.sleep(0.5)
        got = sorted(r.sensor_id for r in spark.table(q.name).collect())
    finally:
        q.stop()
    assert got == ["sensor_1", "sensor_2"]


def test_live_monitor_in_both_domains(spark):
    """One query: means close as event time moves on, and a source that pauses raises wall-clock alerts."""
    folder = f"{checkpoint_dir(spark).removeprefix('file:')}/both-{uuid.uuid4().hex}"
    schema = "sensor_id string, seq long, temperature double, ts timestamp"
    t0 = dt.datetime(2024, 1, 1)

    def feed(rows):
        spark.createDataFrame([(k, i, float(v), t0 + dt.timedelta(seconds=s)) for i, (k, s, v) in enumerate(rows)], schema).coalesce(1).write.mode(
            "append").parquet(folder)

    feed([("a", 0, 1), ("a", 30, 3), ("b", 10, 5)])
    src = spark.readStream.schema(schema).parquet(folder)
    q = (SO.stream_live_monitor(src, "sensor_id", "ts", "temperature", "seq", "1 minute", "3 seconds", "5 seconds")
         .writeStream.format("memory").queryName(f"both_{uuid.uuid4().hex[:8]}").outputMode("append").trigger(processingTime="500 milliseconds").start())

    def wait(done):
        deadline = time.time() + 60
        while time.time() < deadline:
            got = spark.table(q.name).collect()
            if done(got):
                return got
            time.sleep(0.5)
        raise AssertionError(got)

    kinds = lambda got: sorted((r.sensor_id, r.kind, r.value, r.n, r.idle_seconds) for r in got)
    try:
        got = wait(lambda g: len(g) >= 2)  # the source pauses
        assert [x[:2] for x in kinds(got)] == [("a", "alert"), ("b", "alert")] and {r.idle_seconds for r in got} == {3}
        feed([("c", 200, 7)])  # event time moves on: the windows of the first minute end
        got = wait(lambda g: sum(r.kind == "mean" for r in g) >= 2)
        assert {(r.sensor_id, r.value, r.n) for r in got if r.kind == "mean"} == {("a", 2.0, 2), ("b", 5.0, 1)}
        wait(lambda g: any(r.kind == "alert" and r.sensor_id == "c" for r in g))  # and it pauses again
    finally:
        q.stop()


def test_stateful_stream_runs_outside_repo(tmp_path):
    """Python workers must not need this package importable (cwd elsewhere)."""
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parents[1]
    code = (
        f"import sys; sys.path.insert(0, {str(repo)!r})\n"
        "from chronokey.session import get_spark\n"
        f"spark = get_spark('local[2]', **{{'spark.checkpoint.dir': {str(tmp_path / 'ckpt')!r}}})\n"
        "from __spark_entry__ import queries\n"
        "print('ROWS', queries()['stream_early_count_final'](spark, '/root/testdata/sf0.001').count())\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "ROWS 776" in out.stdout, out.stderr[-2000:]


def test_late_rows_dropped_match_audit(spark):
    """A row whose window closed before it arrives: the windowed stream drops
    it (numRowsDroppedByWatermark) and the batch audit flags the same row.
    Spark filters late rows with the previous batch's watermark, so the late
    row comes two batches after the row that moves the watermark."""
    from chronokey import late_audit, tumbling_mean
    from chronokey.streaming.replay import dropped_by_watermark

    t0 = 1738360800000  # 22:00 UTC
    rows = [("u", "a", t0 + 1000), ("v", "a", t0 + 3_700_000), ("w", "a", t0 + 3_700_001), ("u", "late", t0 + 3000)]
    src = _stream(spark, _files(spark, rows, 4))
    sdf = tumbling_mean(src.withWatermark("ts", "5 seconds"), "user_id", "ts", "seq", "1 hour")
    queries = []
    folder = f"{checkpoint_dir(spark).rstrip('/')}/late-{uuid.uuid4().hex}"
    run_to_completion(spark, sdf, folder, queries)
    batch = late_audit(S.user_events(spark, rows), "user_id", "ts", "seq", "5 seconds", "1 hour")
    assert [r.seq for r in batch.filter("is_late").collect()] == [3]
    assert dropped_by_watermark(queries[0]) == 1


@pytest.mark.parametrize("which", ["terminated", "early"])
def test_restart_from_checkpoint(spark, which):
    """Stop after part of the input, add the rest, restart on the same
    checkpoint: state carries over and the total output equals batch."""
    sample = S.TERMINATED_SESSION_SAMPLE if which == "terminated" else S.EARLY_COUNT_SAMPLE
    chunks = _chunks(sample, 4)
    folder = f"{checkpoint_dir(spark).removeprefix('file:')}/src-{uuid.uuid4().hex}"
    _write(folder, chunks[:2])  # first run sees half of the input, no flush

    def build():
        src = _stream(spark, folder)
        if which == "terminated":
            return SO.stream_terminated_sessions(src, delay="5 seconds")
        return SO.stream_early_count(src, delay="5 seconds")

    out = f"{checkpoint_dir(spark).rstrip('/')}/restart-{uuid.uuid4().hex}"
    run_to_completion(spark, build(), out)
    _write(folder, chunks[2:], first_index=2)  # the rest arrives while the query is down
    result = run_to_completion(spark, build(), out).filter(F.col("user_id") != "~flush")

    batch_in = S.user_events(spark, sample)
    if which == "terminated":
        batch = terminated_sessions(batch_in)
        cols = ["user_id", "session_start", "segment", F.array_join("event_types", ","), "closed_by"]
    else:
        batch = early_count(batch_in)
        cols = ["user_id", "window_start", "count", "pane"]
    assert _rows(result, cols) == _rows(batch, cols)


def test_early_count_once_replay(spark):
    src = _stream(spark, _files(spark, S.EARLY_COUNT_SAMPLE, 3))
    out = _run(spark, SO.stream_early_count(src, include_final=False, once=True, delay="5 seconds"))
    batch = early_count(S.user_events(spark, S.EARLY_COUNT_SAMPLE), include_final=False, once=True)
    cols = ["user_id", "window_start", "count", "pane"]
    assert _rows(out, cols) == _rows(batch, cols) == sorted(
        (u, r[1], 5, "early") for u, r in zip(["user_1", "user_2"], _rows(batch, cols))
    )


def test_render_stream_output(spark):
    """J10 messages on a stream's output equal the batch messages."""
    from chronokey import render

    src = _stream(spark, _files(spark, S.TERMINATED_SESSION_SAMPLE, 2))
    sdf = render(SO.stream_terminated_sessions(src, delay="5 seconds"), "terminated_sessions", key="user_id")
    out = _run(spark, sdf)
    batch = render(terminated_sessions(S.user_events(spark, S.TERMINATED_SESSION_SAMPLE)), "terminated_sessions", "user_id")
    assert sorted(r.message for r in out.collect()) == sorted(r.message for r in batch.collect())


@pytest.mark.parametrize("kind", ["long", "string", "double", "timestamp", "binary"])
def test_early_count_state_does_not_grow_with_keys(spark, kind):
    """A state row for each bucket of keys and window, not for each key; null keys and keys of any type in three batches."""
    rows = [(i, "x", f"{i * i % 60}" if i % 9 else None, 1738362000000 + i * 1000) for i in range(400)]
    folder = f"{checkpoint_dir(spark).removeprefix('file:')}/src-{uuid.uuid4().hex}"
    _write(folder, [[(i, k, e, t) for i, e, k, t in rows[a:a + 150]] for a in (0, 150, 300)])
    value = {"long": F.col("user_id").cast("long") + F.lit(2**60), "timestamp": F.timestamp_seconds(F.col("user_id").cast("long"))}.get(
        kind, F.col("user_id").cast("double" if kind == "double" else "string").cast(kind))
    queries = []
    sdf = _stream(spark, folder).withColumn("user_id", value)
    out = run_to_completion(spark, SO.stream_early_count(sdf, width="5 minutes", n=2, delay="5 seconds", buckets=4),
                            f"{checkpoint_dir(spark).rstrip('/')}/out-{uuid.uuid4().hex}", queries)
    batch = early_count(spark.read.parquet(folder).withColumn("ts", F.timestamp_millis("ts_ms")).withColumn("user_id", value), width="5 minutes", n=2)
    cols = ["user_id", "window_start", "window_end", "count", "pane"]
    got, want = (sorted(map(str, d.filter("pane = 'early'").select(*cols).collect())) for d in (out, batch))
    assert got == want and any("None" in r for r in got)
    first = spark.createDataFrame([(1738362000000,)], "t long").select(F.window(F.timestamp_millis("t"), "5 minutes").start).first()[0]
    finals = [sorted(map(str, d.filter((F.col("pane") == "final") & (F.col("window_start") == F.lit(first))).select(*cols).collect())) for d in (out, batch)]
    assert finals[0] == finals[1] and finals[0]
    assert max(o["numRowsTotal"] for p in queries[0].recentProgress for o in p["stateOperators"]) <= 5 * 2


def test_early_count_splits_long_runs():
    import pandas as pd

    from chronokey.streaming import stateful as ST

    class State:
        exists = hasTimedOut = False
        update = setTimeoutTimestamp = lambda self, x: None
        getCurrentWatermarkMs = lambda self: 0

    n = 3 * ST.EARLY_SPAN
    frames = [pd.DataFrame({"__key": [7] * n}), pd.DataFrame({"__key": [7, 8, 8, 7]})]
    runs = pd.concat(ST.early_count_fn(1000, 2, True, False)((0, 0), iter(frames), State()))
    counts = sorted((k, c) for k, a, b in zip(runs["key"], runs["first"], runs["last"]) for c in range(a, b + 1))
    assert counts == [(7, c) for c in range(2, n + 3)] + [(8, 2)]
    assert (runs["last"] - runs["first"]).max() < ST.EARLY_SPAN
