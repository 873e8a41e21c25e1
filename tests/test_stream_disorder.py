"""Stream folds under disorder within the delay, in any cut into batches, and replays of many files."""

import datetime as dt
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronokey import capped_sessions, inactivity_alerts, terminated_sessions
from chronokey.queries import KEY, q_gap_sessions, q_terminated_sessions
from chronokey import queries as Q
from chronokey.sources import read_events
from chronokey.streaming import operators as S
from chronokey.streaming import replay as R
from chronokey.streaming import stateful as ST

US = 1_000_000
T0 = dt.datetime(2024, 1, 1)
BASE = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) * US


class FakeState:
    """The parts of GroupState that the folds use, for one key."""

    def __init__(self):
        self.value, self.wm, self.deadline, self.hasTimedOut = None, 0, None, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = self.deadline = None

    def getCurrentWatermarkMs(self):
        return self.wm

    def setTimeoutTimestamp(self, ms):
        assert ms > self.wm
        self.deadline = ms


def drive(fn, batches, delay_us):
    """Feed batches of row dicts as Spark would: the watermark of a batch comes from those before it."""
    state, out, top = FakeState(), [], 0

    def call(rows, timed_out):
        state.hasTimedOut = timed_out
        if timed_out:
            state.deadline = None
        for frame in fn(("k",), iter([] if timed_out else [pd.DataFrame(rows)]), state):
            out.extend(frame.itertuples(index=False, name=None))

    def run(rows):
        if rows:
            call(rows, False)
        elif state.deadline is not None and state.deadline < state.wm:
            call([], True)

    for rows in batches:
        late = [r for r in rows if r["__us"] < state.wm * 1000]
        assert not late, "the test's disorder exceeds the delay"
        run(rows)
        top = max([top, *(r["__us"] for r in rows)])
        state.wm = max(state.wm, (top - delay_us) // 1000)
        run([])
    state.wm = 10**15
    for _ in range(3):
        run([])
    return out


def disordered(rng, n, delay_s):
    """Rows whose arrival is their time plus at most the delay, with gaps, ties and bursts."""
    t, rows = 0, []
    for i in range(n):
        t += rng.choice([0, 0, 1, 1, 2, 3, 4, 5, 5, 6, 9, 12])
        rows.append({"__us": BASE + t * US, "__seq": i, "__type": rng.choice(["A", "A", "B", None, "LOGOUT"])})
    return sorted(rows, key=lambda r: r["__us"] + rng.random() * delay_s * US)


def cut(rng, rows, k):
    at = sorted(rng.sample(range(1, len(rows)), k - 1))
    return [rows[a:b] for a, b in zip([0, *at], [*at, len(rows)])]


@pytest.mark.parametrize("seed", range(25))
def test_folds_do_not_depend_on_batches(seed):
    rng = random.Random(seed)
    delay = 6
    rows = disordered(rng, 60, delay)
    folds = {
        "alerts": lambda: ST.inactivity_fn(5 * US),
        "terminated": lambda: ST.terminated_session_fn(5 * US, ("LOGOUT",)),
        "terminated counts": lambda: ST.terminated_session_fn(5 * US, ("LOGOUT",), lists=False),
        "capped": lambda: ST.capped_session_fn(5 * US, 7 * US),
        "capped counts": lambda: ST.capped_session_fn(5 * US, 7 * US, lists=False),
    }
    for name, make in folds.items():
        whole = drive(make(), [rows], delay * US)
        for k in (2, 5, 20):
            got = drive(make(), cut(rng, rows, k), delay * US)
            if name == "alerts":  # the end of a silence may be unknown when its alert fires
                assert [r[:4] for r in got] == [r[:4] for r in whole]
            else:
                assert list(map(str, got)) == list(map(str, whole)), (name, k)


@pytest.mark.parametrize("seed", range(3))
def test_folds_equal_batch_operators(spark, seed):
    rng = random.Random(100 + seed)
    rows = disordered(rng, 60, 6)
    df = spark.createDataFrame([("k", r["__seq"], r["__us"], r["__type"]) for r in rows], "user_id string, seq long, us long, event_type string")
    df = df.withColumn("ts", F.timestamp_micros("us"))
    batches = cut(rng, rows, 5)
    us = lambda c: int(c.replace(tzinfo=dt.timezone.utc).timestamp() * US)
    got = [(r[1], r[2], r[3], list(r[4]), r[6]) for r in drive(ST.terminated_session_fn(5 * US, ("LOGOUT",)), batches, 6 * US)]
    want = [(us(r["session_start"]), us(r["session_end"]), r["segment"], r["event_types"], r["closed_by"])
            for r in terminated_sessions(df, gap="5 seconds", terminators=("LOGOUT",)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    got = [(r[1], r[2], r[3], r[5]) for r in drive(ST.capped_session_fn(5 * US, 7 * US), batches, 6 * US)]
    want = [(us(r["session_start"]), us(r["session_end"]), r["n"], r["reason"]) for r in capped_sessions(df, mode="event_time").collect()]
    assert sorted(got) == sorted(want)
    got = [r[1] for r in drive(ST.inactivity_fn(5 * US), batches, 6 * US)]
    want = [us(r["last_seen"]) for r in inactivity_alerts(df, "user_id", threshold="5 seconds", include_open=True).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("seed", range(10))
def test_revised_alerts_name_the_next_row(seed):
    """However the rows are cut, the last word on each silence is the row that ends it."""
    rng = random.Random(300 + seed)
    rows = disordered(rng, 60, 6)
    times = sorted(r["__us"] for r in rows)
    want = {a: b for a, b in zip(times, [*times[1:], None]) if b is None or b - a >= 5 * US}
    for k in (1, 5, 20):
        got = {}
        for r in drive(ST.inactivity_fn(5 * US, revise=True), [rows] if k == 1 else cut(rng, rows, k), 6 * US):
            assert r[2:4] == (r[1] + 5 * US, 5) and got.get(r[1]) is None  # none is revised twice
            got[r[1]] = None if pd.isna(r[4]) else r[4]
        assert got == want


def test_replayed_alerts_in_batches_name_the_next_row(spark, many_files, tmp_path):
    out = R.replay(spark, many_files, "alerts", [KEY, Q.SEQ, "ts"],
                   lambda s: S.stream_inactivity_alerts(s, KEY, "ts", Q.SEQ, Q.IDLE, "event", "1 hour", revise=True),
                   folder=f"{tmp_path}/a", max_files_per_trigger=1)
    got = Q.project_alerts(S.revised_alerts(out, KEY)).collect()
    want = Q.q_inactivity_alerts_open(spark, "/root/testdata/sf0.001").collect()
    assert out.filter("next_seen is null").count() > sum(r["next_seen_us"] is None for r in want)  # some are revised
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_null_values_in_means():
    rows = [{"__us": BASE + i * US, "__seq": i, "__value": None if i % 3 else 1.0} for i in range(12)]
    got = drive(ST.arrival_mean_fn(100 * US, ["__seq"]), [rows[:5], rows[5:]], 0)
    assert [(r[3], r[4]) for r in got] == [(12, 1.0)]
    got = drive(ST.arrival_mean_fn(100 * US, ["__seq"]), [[dict(r, __value=None) for r in rows]], 0)
    assert [(r[3], r[4]) for r in got] == [(12, None)]


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """``events`` as a folder of four part files, by time."""
    folder = tmp_path_factory.mktemp("many")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartitionByRange(4, "ts").write.parquet(f"{folder}/events.parquet")
    for i, f in enumerate(sorted(folder.glob("events.parquet/part-*"))):  # files are taken by age
        os.utime(f, (f.stat().st_mtime - 100 + i,) * 2)
    return str(folder)


def test_replay_of_a_folder_of_files(spark, many_files, tmp_path):
    assert read_events(spark, many_files, [KEY, "ts"]).count() == 1000
    progress = []
    out = R.replay(spark, many_files, "gap", [KEY, "ts"], lambda s: S.stream_gap_sessions(s, KEY, "ts", Q.GAP, "400 days"),
                   folder=f"{tmp_path}/gap", max_files_per_trigger=1, progress=progress)
    assert sum(R.dropped_by_watermark(q) for q in progress) == 0
    assert sum(len([p for p in q.recentProgress if p["numInputRows"]]) for q in progress) == 5
    want = q_gap_sessions(spark, "/root/testdata/sf0.001")
    assert sorted(map(str, Q.project_gap(out).collect())) == sorted(map(str, want.collect()))
    again = R.replay(spark, many_files, "gap", [KEY, "ts"], lambda s: S.stream_gap_sessions(s, KEY, "ts", Q.GAP, "400 days"),
                     folder=f"{tmp_path}/gap", max_files_per_trigger=1)
    assert again.count() == out.count()


def test_replay_of_stateful_sessions_in_batches(spark, many_files, tmp_path):
    out = R.replay(spark, many_files, "terminated", [KEY, Q.SEQ, "ts", "event_type"],
                   lambda s: S.stream_terminated_sessions(s, KEY, "ts", Q.SEQ, "event_type", Q.GAP, Q.EVENT_TERMINATORS, "1 hour"),
                   folder=f"{tmp_path}/t", max_files_per_trigger=1)
    # project_terminated joins the list of types, as the batch query does
    want = q_terminated_sessions(spark, "/root/testdata/sf0.001")
    assert sorted(map(str, Q.project_terminated(out).collect())) == sorted(map(str, want.collect()))
