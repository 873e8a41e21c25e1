"""Streams that keep every row: equal to batch whatever the order, revised at once, safe to run again."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronokey import arrival_window_mean, capped_sessions, gap_sessions, inactivity_alerts, terminated_sessions
from chronokey.streaming.revised import ArrivalMeanStream, CappedSessionStream, GapSessionStream, InactivityAlertStream, TerminatedSessionStream
from chronokey.streaming.versions import VersionedTable

SCHEMA = "user_id long, ts timestamp, seq long, event_type string, value double, part int"
T0 = dt.datetime(2024, 1, 1)
GAP, MAX = dt.timedelta(seconds=60), dt.timedelta(seconds=150)
HOT = 7


def events(seed, n, parts=3):
    """Rows whose arrival has nothing to do with their time; a third of them of one key; ties, null keys and null times."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = HOT if i % 3 == 0 else rng.choice([1, 2, 3, None])
        t = None if rng.random() < 0.02 else T0 + dt.timedelta(seconds=rng.choice([0, 59, 60, 61, 150]) + rng.randrange(0, 40 * n, 20))
        rows.append((key, t, i, rng.choice(["click", "LOGOUT", "view", None]), rng.choice([None, float(rng.randrange(9))]), i * parts // n))
    return rows


def fed(spark, op, rows, folder, parts=3):
    """Feed the parts one after another; returns what each run had put out."""
    df = spark.createDataFrame(rows, SCHEMA)
    seen = []
    for k in range(parts):
        df.filter(F.col("part") == k).write.mode("overwrite").parquet(f"{folder}/feed/part={k}")
        sdf = spark.readStream.schema(df.schema).option("basePath", f"{folder}/feed").parquet(f"{folder}/feed/part=*")
        seen.append(op.run(sdf).collect())
    return seen


def canon(df):
    df = df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes])
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("target_rows", [None, 20])
def test_arrival_mean_equals_batch(spark, tmp_path, target_rows):
    rows = events(1, 300)
    op = ArrivalMeanStream(spark, str(tmp_path / "op"), T.LongType(), "user_id", "ts", "value", "seq", "5 minutes", target_rows=target_rows)
    fed(spark, op, rows, str(tmp_path))
    df = spark.createDataFrame([r for r in rows if r[1]], SCHEMA)
    want = arrival_window_mean(df, "user_id", "ts", "value", "seq", "5 minutes")
    assert canon(op.flush()) != []
    assert canon(op.flush().drop("revision")) == canon(want)


@pytest.mark.parametrize("kind, target_rows", [("terminated", None), ("terminated", 20), ("capped", 20), ("gap", None), ("alerts", None)])
def test_sessions_equal_batch(spark, tmp_path, kind, target_rows):
    """Parts overlap in time over the whole range, so late rows bridge, cut and reorder sessions said before."""
    rows = events(2, 240)
    df = spark.createDataFrame(rows, SCHEMA)
    if kind == "terminated":
        op = TerminatedSessionStream(spark, str(tmp_path / "op"), T.LongType(), gap=GAP, target_rows=target_rows)
        want = terminated_sessions(df, gap=GAP)
    elif kind == "gap":
        op = GapSessionStream(spark, str(tmp_path / "op"), T.LongType(), gap=GAP)
        want = gap_sessions(df, gap=GAP)
    elif kind == "alerts":
        op = InactivityAlertStream(spark, str(tmp_path / "op"), T.LongType(), "user_id", threshold=GAP)
        want = inactivity_alerts(df, "user_id", "ts", "seq", GAP, True).drop("next_seen")
    else:
        op = CappedSessionStream(spark, str(tmp_path / "op"), T.LongType(), gap=GAP, max_len=MAX, target_rows=target_rows)
        want = capped_sessions(df, gap=GAP, max_len=MAX, mode="event_time")
    seen = fed(spark, op, rows, str(tmp_path))
    op.flush()
    assert canon(op.latest().select(*want.columns)) == canon(want.withColumn("idle_seconds", F.col("idle_seconds").cast("long")) if kind == "alerts" else want)
    assert any(r["retracted"] for r in seen[-1]) and len(seen[0]) < len(seen[1]) < len(seen[2])


def at(s):
    return T0 + dt.timedelta(seconds=s)


def row(user, s, seq, kind, part):
    return user, at(s), seq, kind, None, part


def test_terminator_fires_at_once_and_is_revised(spark, tmp_path):
    """The terminator's segment comes with its batch, before the watermark; a row within the delay corrects it."""
    rows = [row(1, 0, 0, "login", 0), row(1, 10, 1, "LOGOUT", 0), row(1, 5, 2, "click", 1), row(2, 500, 3, "login", 2), row(1, -55, 4, "early", 2)]
    op = TerminatedSessionStream(spark, str(tmp_path / "op"), T.LongType(), gap=GAP, delay="1 hour")
    first, second, third = fed(spark, op, rows, str(tmp_path))
    said = lambda seen, v: sorted((r["session_start"], r["segment"], r["event_types"], r["retracted"]) for r in seen if r["revision"] == v)
    assert said(first, 0) == [(at(0), 0, ["login", "LOGOUT"], False)]
    assert said(second, 1) == [(at(0), 0, ["login", "click", "LOGOUT"], False)]
    # The early row moves the session's start: the old id goes, the new one comes. User 2's session is still open.
    assert said(third, 2) == [(at(-55), 0, ["early", "login", "click", "LOGOUT"], False), (at(0), 0, ["login", "click", "LOGOUT"], True)]
    op.flush()
    assert [(r["user_id"], r["event_types"]) for r in op.latest().orderBy("user_id").collect()] == [
        (1, ["early", "login", "click", "LOGOUT"]), (2, ["login"])]


def test_open_session_is_said_when_the_watermark_passes(spark, tmp_path):
    """No new row of its key is needed; the cap closes once passed, inactivity at its deadline."""
    rows = [row(1, 0, 0, "a", 0), row(2, 60, 1, "a", 1), row(2, 61, 2, "a", 2)]
    op = CappedSessionStream(spark, str(tmp_path / "op"), T.LongType(), gap=GAP, max_len=MAX)
    seen = fed(spark, op, rows, str(tmp_path))
    assert [[(r["user_id"], r["reason"], r["revision"]) for r in s] for s in seen] == [[], [(1, "Inactivity", 1)], [(1, "Inactivity", 1)]]


def test_batch_that_runs_again(spark, tmp_path):
    """A batch that ran and is run again, as after a failure, counts once."""
    rows = events(3, 90)
    df = spark.createDataFrame(rows, SCHEMA)
    op = CappedSessionStream(spark, str(tmp_path / "op"), T.LongType(), gap=GAP, max_len=MAX)
    op.begin()
    for k in (0, 1, 1, 2, 2):
        op.update(df.filter(F.col("part") == k), k)
    op.flush()
    assert canon(op.latest()) == canon(capped_sessions(df, gap=GAP, max_len=MAX, mode="event_time"))


def test_versions_are_compacted(spark, tmp_path):
    """Reads meet a base and the versions after it; rows that are gone stay gone, null ids are ids."""
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    t = VersionedTable(spark, str(tmp_path / "t"), schema, "k", ["k"], buckets=2, compact_every=3)
    held = {}
    rng = random.Random(4)
    for version in range(8):
        assert {r["k"]: r["v"] for r in t.read(version).collect()} == held
        rows = {rng.choice([None, *range(6)]): (rng.randrange(99), rng.random() < 0.3) for _ in range(4)}
        t.write(spark.createDataFrame([(k, v, g) for k, (v, g) in rows.items()], "k long, v long, __gone boolean"), version)
        for k, (v, g) in rows.items():
            held.pop(k, None) if g else held.update({k: v})
    assert len(t._folders(8)) == 3  # base 6, versions 6 and 7
    assert {r["k"]: r["v"] for r in t.read(8, [0]).collect()} | {r["k"]: r["v"] for r in t.read(8, [1]).collect()} == held


def test_log_writes_new_rows_only(spark, tmp_path):
    """What a batch adds to the row log is its own rows, however many are held."""
    rows = events(5, 400, parts=4)
    df = spark.createDataFrame(rows, SCHEMA)
    op = TerminatedSessionStream(spark, str(tmp_path / "op"), T.LongType(), gap=GAP)
    op.begin()
    for k in range(4):
        op.update(df.filter(F.col("part") == k), k)
    held = [spark.read.parquet(str(tmp_path / f"op/log/__folder=delta-{k}")).count() for k in range(4)]
    assert held == [sum(r[5] == k and r[1] is not None for r in rows) for k in range(4)]
    size = [sum(p.stat().st_size for p in (tmp_path / f"op/log/__folder=delta-{k}").rglob("*.parquet")) for k in range(4)]
    assert max(size) < 1.5 * min(size)
