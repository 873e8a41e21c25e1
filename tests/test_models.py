"""Randomised check of every operator against a plain-Python model.

Each key of a generated table is one random case (hundreds per Spark job),
with time steps drawn to hit the boundaries: equal times, exactly gap,
exactly max, exactly threshold. Every operator runs unbucketed, with tiny
buckets (many splits per key) and with automatic buckets.
"""

import random

import pytest
from pyspark.sql import functions as F

from chronokey import (
    arrival_window_mean,
    capped_sessions,
    early_count,
    gap_sessions,
    inactivity_alerts,
    late_audit,
    terminated_sessions,
)
from chronokey.plans.scan import auto_bucket

import models

GAP, MAX, W, THR = 5_000, 7_000, 10_000, 4_000
STEPS = [0, 1, 500, 1000, 2000, 4000, 4999, 5000, 5001, 7000, 7001, 10_000, 30_000]
TYPES = ["a", "b", "STOP"]


def make_rows(seed, keys=120):
    rnd = random.Random(seed)
    rows, seq = [], 0
    for k in range(keys):
        t = rnd.choice([0, 3000, 9999])
        for _ in range(rnd.randint(1, 25)):
            t += rnd.choice(STEPS)
            rows.append((f"k{k}", seq, t, rnd.choice(TYPES), float(rnd.randint(0, 100))))
            seq += 1
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def table(spark, request):
    rows = make_rows(request.param)
    df = spark.createDataFrame(rows, "user_id string, seq long, ts_ms long, event_type string, value double")
    return rows, df.withColumn("ts", F.timestamp_millis("ts_ms"))


BUCKETS = [None, 3, "auto"]


def _bucket(b, ms_width):
    # ints are widths in the unit of the scan's order value (microseconds here)
    return b * ms_width * 1000 if isinstance(b, int) else b


@pytest.mark.parametrize("b", BUCKETS)
def test_capped(table, b):
    rows, df = table
    for mode in ("arrival", "event_time"):
        want = models.capped([(k, s, t) for k, s, t, _, _ in rows], GAP, MAX, mode)
        for fold_limit in (None, 3):
            out = capped_sessions(df, gap=GAP, max_len=MAX, mode=mode, bucket=_bucket(b, 2000), fold_limit=fold_limit)
            got = {
                (r.user_id, r.s, r.e, r.n, tuple(r.ts), r.reason)
                for r in out.select(
                    "user_id", F.unix_millis("session_start").alias("s"), F.unix_millis("session_end").alias("e"), "n",
                    F.transform("timestamps", F.unix_millis).alias("ts"), "reason",
                ).collect()
            }
            assert got == want, (mode, fold_limit)


@pytest.mark.parametrize("b", BUCKETS)
def test_terminated(table, b):
    rows, df = table
    want = models.terminated([(k, s, t, e) for k, s, t, e, _ in rows], GAP, {"STOP"})
    out = terminated_sessions(df, gap=GAP, terminators=("STOP",), bucket=_bucket(b, 2000))
    got = {
        (r.user_id, r.s, r.e, r.segment, tuple(r.event_types), r.closed_by)
        for r in out.select(
            "user_id", F.unix_millis("session_start").alias("s"), F.unix_millis("session_end").alias("e"), "segment",
            "event_types", "closed_by",
        ).collect()
    }
    assert got == want


@pytest.mark.parametrize("b", BUCKETS)
def test_gap_sessions(table, b):
    rows, df = table
    want = models.gap_sessions([(k, s, t) for k, s, t, _, _ in rows], GAP)
    out = gap_sessions(df, gap=GAP, bucket=_bucket(b, 1000))
    got = {
        (r.user_id, r.s, r.e, r.n)
        for r in out.select(
            "user_id", F.unix_millis("session_start").alias("s"), F.unix_millis("session_end").alias("e"), "n"
        ).collect()
    }
    assert got == want


@pytest.mark.parametrize("b", BUCKETS)
def test_arrival_mean(table, b):
    rows, df = table
    want = models.arrival_mean([(k, s, t, v) for k, s, t, _, v in rows], W)
    out = arrival_window_mean(df, "user_id", "ts", "value", "seq", W, bucket=b if b != 3 else 7)
    got = {(r.user_id, r.e): (r.n, r.mean) for r in out.select("user_id", F.unix_millis("window_end").alias("e"), "n", "mean").collect()}
    assert got.keys() == want.keys()
    for k, (n, mean) in want.items():
        assert got[k][0] == n and got[k][1] == pytest.approx(mean)


@pytest.mark.parametrize("b", BUCKETS)
def test_early(table, b):
    rows, df = table
    want = models.early([(k, s, t) for k, s, t, _, _ in rows], W, 3, True)
    out = early_count(df, "user_id", "ts", "seq", W, 3, True, bucket=b if b != 3 else 5)
    got = sorted(tuple(r) for r in out.select("user_id", F.unix_millis("window_start"), "count", "pane").collect())
    assert got == want


@pytest.mark.parametrize("b", BUCKETS)
def test_alerts(table, b):
    rows, df = table
    for include_open in (False, True):
        want = models.alerts([(k, s, t) for k, s, t, _, _ in rows], THR, include_open)
        out = inactivity_alerts(df, "user_id", "ts", "seq", THR, include_open, bucket=_bucket(b, 2000))
        got = sorted(
            tuple(r)
            for r in out.select(
                "user_id", F.unix_millis("last_seen"), F.unix_millis("alert_time"), F.unix_millis("next_seen")
            ).collect()
        )
        assert got == want


@pytest.mark.parametrize("b", BUCKETS)
def test_late(table, b):
    rows, df = table
    want = models.late([(k, s, t) for k, s, t, _, _ in rows], 3000, W)
    out = late_audit(df, "user_id", "ts", "seq", 3000, W, bucket=b if b != 3 else 50)
    got = {r.seq: (r.wm, r.is_late) for r in out.select("seq", F.unix_millis("watermark_before").alias("wm"), "is_late").collect()}
    assert got == want


def test_auto_bucket_splits_hot_key(spark):
    # one key holds most rows: auto picks a width that splits it
    df = spark.range(0, 20_000).select((F.col("id") % 10 == 0).cast("string").alias("k"), F.col("id").alias("v"))
    assert auto_bucket(df, ["k"], F.col("v"), target_rows=1_000_000) is None
    b = auto_bucket(df, ["k"], F.col("v"), target_rows=1_000)
    assert b is not None
    per = df.groupBy("k", b.alias("b")).count().agg(F.max("count")).first()[0]
    assert per <= 1_100
