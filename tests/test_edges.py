"""Null keys, null order, repeated order values and repeated times: every plan gives the same rows."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from chronokey import arrival_window_mean, capped_sessions, early_count, gap_sessions, inactivity_alerts, terminated_sessions
from chronokey.operators.late import late_audit

T0 = dt.datetime(2024, 1, 1)


def table(spark, case):
    """24 rows over two keys; times cluster so that sessions, silences and windows all occur."""
    rows = []
    for i in range(24):
        key = None if case == "null key" and i % 2 else f"k{i % 2}"
        seq = None if case == "null order" and i % 4 == 0 else 5 if case == "repeated seq" else i
        step = [0, 1, 1, 2, 3, 3, 9, 10, 11, 30, 31, 33][i // 2]
        ts = T0 + dt.timedelta(seconds=0 if case == "repeated ts" and i < 12 else step)
        rows.append((key, seq, ts, float(i), "LOGOUT" if i % 5 == 0 else "VIEW"))
    return spark.createDataFrame(rows, "user_id string, seq long, ts timestamp, value double, event_type string")


def bag(df):
    return sorted(str(tuple(r)) for r in df.collect())


CASES = ["plain", "null key", "null order", "repeated seq", "repeated ts"]


@pytest.mark.parametrize("case", CASES)
def test_capped_sessions_same_on_every_path(spark, case):
    df = table(spark, case)
    want = bag(capped_sessions(df, bucket=None, fold_limit=None))
    assert sum(r["n"] for r in capped_sessions(df).collect()) == 24
    for bucket in (None, 2_000_000, "auto"):
        for limit in (None, 3, 0):
            assert bag(capped_sessions(df, bucket=bucket, fold_limit=limit)) == want, (bucket, limit)


@pytest.mark.parametrize("case", CASES)
def test_bucketed_scans_keep_every_row(spark, case):
    df = table(spark, case)
    whole = dict(width="20 seconds", seq="seq")
    if case == "repeated seq":  # the order among equal seq is not given: counts only
        for b in (None, 3):
            assert sum(r["n"] for r in arrival_window_mean(df, "user_id", "ts", "value", bucket=b, **whole).collect()) == 24
            assert sum(r["count"] for r in early_count(df, n=2, bucket=b, **whole).filter("pane = 'final'").collect()) == 24
    elif case != "null order":
        assert bag(arrival_window_mean(df, "user_id", "ts", "value", bucket=3, **whole)) == bag(arrival_window_mean(df, "user_id", "ts", "value", bucket=None, **whole))
        assert bag(early_count(df, n=2, bucket=3, **whole)) == bag(early_count(df, n=2, bucket=None, **whole))
    else:
        for b in (None, 3, "auto"):
            assert sum(r["n"] for r in arrival_window_mean(df, "user_id", "ts", "value", bucket=b, **whole).collect()) == 24
        assert bag(early_count(df, n=2, bucket=3, **whole)) == bag(early_count(df, n=2, bucket=None, **whole))
    assert late_audit(df, width="20 seconds").count() == 24


@pytest.mark.parametrize("case", CASES)
def test_session_operators_same_on_every_path(spark, case):
    df = table(spark, case)
    assert bag(gap_sessions(df, gap="5 seconds")) == bag(gap_sessions(df, gap="5 seconds", bucket=None))
    assert bag(inactivity_alerts(df, "user_id", threshold="5 seconds", include_open=True)) == bag(
        inactivity_alerts(df, "user_id", threshold="5 seconds", include_open=True, bucket=None))
    ordered = df.withColumn("event_type", F.lit("VIEW")) if case in ("repeated seq", "null order") else df
    assert bag(terminated_sessions(ordered, gap="5 seconds", bucket=1_000_000)) == bag(terminated_sessions(ordered, gap="5 seconds", bucket=None))


def test_long_span_doubling_ends(spark):
    """13 rows over a year: the chain's own length bounds the levels, not the key's span."""
    times = [0, 1, 6, 8, 9, 3600, *(86_400 * d for d in (30, 60, 100, 200, 300, 364)), 86_400 * 364 + 3]
    df = spark.createDataFrame([("k", i, T0 + dt.timedelta(seconds=s)) for i, s in enumerate(times)], "user_id string, seq long, ts timestamp")
    began = time.time()
    got = bag(capped_sessions(df, fold_limit=0))
    assert time.time() - began < 60
    assert got == bag(capped_sessions(df))


def test_epoch_micros_as_time_column(spark):
    df = table(spark, "plain")
    long = df.withColumn("us", F.unix_micros("ts"))
    assert bag(inactivity_alerts(long, "user_id", "us", threshold="5 seconds")) == bag(inactivity_alerts(df, "user_id", "ts", threshold="5 seconds"))


def test_hot_session_has_no_window_over_segments(spark):
    df = table(spark, "plain")
    plan = terminated_sessions(df, gap="5 seconds", bucket=1_000_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(__session" not in plan and "session_start_us#" in plan
